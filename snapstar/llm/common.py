"""What the corpus operators share: typed columns, raw bytes of Arrow text, connected components."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from snapstar.session import stored

#: The bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def kind_of(df: DataFrame, column: str) -> DataType:
    return df.schema[column].dataType


def with_columns(schema: StructType, added: StructType) -> StructType:
    """``schema`` followed by ``added``; an added column takes the place of one of the same name."""
    names = {f.name.lower() for f in added}
    return StructType([f for f in schema if f.name.lower() not in names] + list(added))


def appended(df: DataFrame, added: StructType, values: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """All rows with further columns, which ``values`` finds for a batch at a time."""
    schema = with_columns(df.schema, added)
    kept = [f.name for f in schema][: len(schema) - len(added)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(name)) for name in kept]
            yield pa.RecordBatch.from_arrays(columns + values(batch), [f.name for f in schema])

    return df.mapInArrow(rows, schema)


def field(name: str, kind: DataType) -> StructField:
    return StructField(name, kind, True)


def released(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go now. Spark deletes them as the driver's garbage is collected.

    The last query stays reachable until another one ends, so that an empty one goes first.
    """
    spark.range(1).count()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offsets of each; a null text is empty."""
    texts = pc.fill_null(texts, pa.scalar("", texts.type)).cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def slices(data: bytes, size: int = 4 << 20) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, cut at white space only."""
    at = 0
    while len(data) - at > size:
        cut = at + size
        end = min((i for i in (data.find(s, cut) for s in (b" ", b"\n", b"\t", b"\x0b", b"\x0c", b"\r")) if i >= 0), default=-1)
        if end < 0:
            break
        yield data[at:end]
        at = end
    yield data[at:]


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for all nodes of undirected ``edges`` (a, b); the root is the least node that can be reached.

    Tasks first contract the edges that they hold. Then large and small stars
    alternate until nothing changes; each round is written to the shared folder.
    Loops and repeated edges are harmless, no edges give no rows.
    """
    now = stored(edges.mapInArrow(_contract, "a long, b long").distinct(), name)
    while True:
        least = now.groupBy("b").agg(F.min("a").alias("m"))
        # Large star: whatever is above a node goes to the least node beside it.
        low = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = low.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = low.filter("b > a").join(around, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        # Small star: whatever is below a node, and the node, go to the least of them.
        below = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(below, "b")
        after = stored(
            small.select(F.col("m").alias("a"), F.col("a").alias("b"))
            .unionByName(small.select(F.col("m").alias("a"), "b"))
            .filter("a < b")
            .distinct(),
            name,
        )
        if _digest(after) == _digest(now):
            return least.select(F.col("b").alias("node"), F.col("m").alias("root")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        now = after


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a batch as one star for each group of nodes that they join."""
    for batch in batches:
        nodes, ends = np.unique(np.concatenate([batch.column(0), batch.column(1)]), return_inverse=True)
        left, right = ends[: len(batch)], ends[len(batch) :]
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[left], root[right])
            before = root.copy()
            np.minimum.at(root, root[left], low)
            np.minimum.at(root, root[right], low)
            root = root[root]
            if np.array_equal(root, before):
                break
        far = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[root[far]]), pa.array(nodes[far])], ["a", "b"])
