"""Near-duplicates by SimHash: pigeonhole blocks, Hamming distance, connected groups."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from snapstar.llm.common import appended, components, field, raw, slices
from snapstar.session import stored

SHINGLE, DISTANCE, SEED = 3, 3, 42
#: Fingerprints in one comparison; larger buckets are compared part by part.
CHUNK = 2048


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a UTF-8 text, as a signed integer; 0 without a word."""
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for part in slices(text.lower()):  # of bytes, so that only A-Z change
        words = tail + part.split()
        tail = words[max(0, len(words) - shingle + 1) :]
        if len(words) < shingle:
            continue
        ones, total = _add(ones, _hashes(words, shingle, seed)), total + len(words) - shingle + 1
    if not total and tail:
        ones, total = _add(ones, [xxhash.xxh64_intdigest(b" ".join(tail), seed)]), 1
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view(np.int64)[0])


def _hashes(words: list[bytes], shingle: int, seed: int) -> list[int]:
    joined, one = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return [one(joined[a:b], seed) for a, b in spans]


def _add(ones: np.ndarray, hashes: list[int]) -> np.ndarray:
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], np.uint64).view(np.uint8).reshape(-1, 8)
        ones = ones + np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return ones


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """``docs`` with a column ``simhash`` (long). Of the words, only A-Z are lower-cased.

    Repeated shingles count each time; a text of fewer words than ``shingle`` is
    one shingle; null, empty or blank texts have fingerprint 0.
    """

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        data, at = raw(batch.column(batch.schema.get_field_index(text)))
        found = [fingerprint(data[a:b].tobytes(), shingle) for a, b in zip(at[:-1], at[1:], strict=True)]
        return [pa.array(found, pa.int64())]

    return appended(docs, StructType([field("simhash", LongType())]), values)


def masks(distance: int = DISTANCE, blocks: int | None = None) -> list[int]:
    """The pigeonhole tables, as signed bit masks.

    Of ``blocks`` blocks of the 64 bits, ``distance`` differing bits touch at most
    ``distance``; some choice of the others is equal in both fingerprints.
    """
    blocks = blocks or distance + 2
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    each = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    found = [sum(chosen) for chosen in combinations(each, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``prints`` (simhash) that join whatever lies within ``distance``.

    Fingerprints that agree in a pigeonhole table share a bucket. A bucket beyond
    ``CHUNK`` is compared chunk against chunk, each pair of chunks on its own, so
    that no pair is left out and no task holds more than two chunks. Of the links
    in a comparison only a spanning forest leaves the task.
    """
    keys = [F.struct(F.lit(t).alias("t"), F.col("simhash").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks(distance))]
    keyed = prints.select("simhash", F.explode(F.array(*keys)).alias("k")).select("k.t", "k.key", "simhash")
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / CHUNK)
    split = (
        keyed.join(shared, ["t", "key"])
        .withColumn("own", F.pmod(F.xxhash64("simhash"), parts))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .select("t", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "simhash")
    )
    group = ["t", "key", "lo", "hi"]
    dealt = split.repartition(*group).sortWithinPartitions(*group, "simhash")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            if not len(batch):
                continue
            now = np.stack([np.asarray(c) for c in batch.columns])
            now = now if left is None else np.concatenate([left, now], 1)
            new = np.flatnonzero((now[:4, 1:] != now[:4, :-1]).any(0)) + 1
            cut = new[-1] if len(new) else 0
            left = now[:, cut:]
            if cut:
                yield _forest(now[:, :cut], distance)
        if left is not None:
            yield _forest(left, distance)

    return dealt.mapInArrow(rows, "a long, b long").distinct()


def _forest(rows: np.ndarray, distance: int) -> pa.RecordBatch:
    """A spanning forest of the links in each group of sorted rows (t, key, lo, hi, fingerprint)."""
    prints = rows[4].view(np.uint64) if rows[4].flags.c_contiguous else np.ascontiguousarray(rows[4]).view(np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], (rows[:4, 1:] != rows[:4, :-1]).any(0)]))
    sizes = np.diff(np.append(starts, rows.shape[1]))
    end = np.repeat(starts + sizes, sizes)
    root, alive, found = np.arange(len(prints)), np.arange(len(prints)), []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for step in range(1, int(sizes.max())):
        alive = alive[alive + step < end[alive]]
        near = alive[np.bitwise_count(prints[alive] ^ prints[alive + step]) <= distance]
        near = near[root[near] != root[near + step]]
        for a in near.tolist():
            if (x := top(a)) != (y := top(a + step)):
                root[max(x, y)] = min(x, y)
                found.append((a, a + step))
        if len(near):
            while not np.array_equal(flat := root[root], root):
                root[:] = flat
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return pa.RecordBatch.from_arrays([pa.array(rows[4][a]), pa.array(rows[4][b])], ["a", "b"])


def groups(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(simhash, root) for every fingerprint that is linked to another one; ``prints`` has column simhash, repeats or not."""
    found = components(links(prints.select("simhash").distinct(), distance), "simhash-links")
    return stored(found.select(F.col("node").alias("simhash"), "root"), "simhash-groups")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, simhash, component_id): the least id that links of ``distance`` bits or fewer reach, one row per document.

    Equal fingerprints, 0 among them, are one class, so that copies are never
    expanded into pairs. A group whose ids are all null has a null component; a
    repeated row appears as often as it is given. Other columns are left out.
    """
    prints = stored(fingerprints(docs.select(id, text), shingle, text).select(id, "simhash"), "simhash-rows")
    each = _rooted(prints, distance, F.min(id).alias("least"))
    least = each.groupBy("root").agg(F.min("least").alias("component_id"))
    found = stored(each.join(least, "root").select("simhash", "component_id"), "simhash-components")
    return prints.join(found, "simhash").select(id, "simhash", "component_id")


def _rooted(prints: DataFrame, distance: int, first: Column) -> DataFrame:
    """(simhash, root, ``first``), a row for each fingerprint, however many documents share it."""
    each = stored(prints.groupBy("simhash").agg(first), "simhash-each")
    rooted = each.join(groups(each, distance), "simhash", "left")
    return rooted.withColumn("root", F.coalesce("root", "simhash"))


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates: the least id (nulls last), then the least hash of the text.

    All columns are kept; of rows that repeat a kept one, one stays.
    """
    keys = [F.xxhash64(F.col(id).isNull(), id).alias("_id_hash"), F.xxhash64(text).alias("_text_hash")]
    prints = stored(fingerprints(docs.select(id, text, *keys), shingle, text).drop(text), "simhash-rows")
    one = F.min(F.struct(F.col(id).isNull(), id, "_text_hash", "_id_hash")).alias("one")
    first = _rooted(prints, distance, one).groupBy("root").agg(F.min("one").alias("one"))
    kept = first.select("one._id_hash", "one._text_hash").distinct()
    chosen = docs.select("*", *keys).join(kept, ["_id_hash", "_text_hash"])
    alone = F.row_number().over(Window.partitionBy("_id_hash", "_text_hash").orderBy("_text_hash"))
    return chosen.withColumn("_row", alone).filter("_row = 1").select(*docs.columns)
