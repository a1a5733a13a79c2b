"""Best-fit packing of token pieces into sequences of a fixed capacity."""

from __future__ import annotations

import os
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructType

from snapstar.llm.common import field, kind_of, raw, slices
from snapstar.session import stored

CAPACITY = 2048
END = 0
#: Bytes of words and ids that a task remembers.
MEMORY = 6 << 20
#: Rows of a hot length are numbered in so many parts.
SPREAD = 128


class Words(dict):
    """The ids of words between white space, as bytes, found by a tokenizer and remembered.

    A word of letters alone is one token of the pre-tokenizer, so that only the
    tokenizer's model is asked; anything else is encoded in full. When ``MEMORY``
    bytes are held, further words are found each time. A tokenizer for which the
    two ways differ on the probes is always asked in full.
    """

    #: Words on which both ways are compared.
    PROBES = ("a", "the", "Hello", "unmistakable", "straße", "ÉTÉ", "señor", "Ωμέγα", "naïveté")

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.held = Tokenizer.from_file(path), 0
        self.normalizer, self.model = self.tokenizer.normalizer, self.tokenizer.model
        # Byte-level models name printable bytes by themselves and the others from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.names = {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}
        self.short = self.normalizer is not None and all(self._model(w) == self._full(w) for w in self.PROBES)

    def _full(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _model(self, word: str) -> list[int]:
        """The ids of a word that is all letters, after normalisation too; else those of the full way."""
        text = word.lower() if word.isascii() else self.normalizer.normalize_str(word)
        if not text.isalpha():
            return self._full(word)
        return [t.id for t in self.model.tokenize(text if word.isascii() else text.encode().decode("latin-1").translate(self.names))]

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        ids = self._model(text) if self.short else self._full(text)
        found = array("I", ids).tobytes()
        if self.held < MEMORY:
            self[word] = found
            self.held += len(word) + len(found)
        return found


def _spaced(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts and their offsets, with a space between a letter a-z and a mark after it.

    Tokens never cross from one to the other, and words without the mark are met more often.
    """
    letter, mark = np.zeros(256, bool), np.zeros(256, bool)
    letter[[*range(65, 91), *range(97, 123)]] = True
    mark[list(b".,;:!?")] = True
    put = np.flatnonzero(letter[data[:-1]] & mark[data[1:]]) + 1
    return np.insert(data, put, 32), at + np.searchsorted(put, at, "left")


def _lowered(text: bytes) -> bytes:
    """In lower case if that can't change any id: not beside marks that combine, nor in what may be a special token."""
    return text.lower() if text.isascii() and b"<|" not in text else text


def tokens(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, start, length, ids): each document's token ids, then ``END``, cut at every ``capacity`` tokens.

    ``path`` is a tokenizer file that lower-cases, drops white space and parts
    letters from marks, so that words are encoded on their own and remembered.
    ``ids`` holds little-endian unsigned 32-bit integers. A null or empty text is
    ``END`` alone; repeated rows give repeated pieces; other columns are left out.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    schema = StructType(
        [field(id, kind_of(docs, id)), field("piece", IntegerType()), field("start", LongType())]
        + [field("length", LongType()), field("ids", BinaryType())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        one = words.__getitem__
        for batch in batches:
            data, at = raw(batch.column(1))
            first = 0
            while first < len(batch):
                last = max(first + 1, int(np.searchsorted(at, at[first] + (2 << 20), "right")) - 1)
                own, ends = _spaced(data[at[first] : at[last]], at[first : last + 1] - at[first])
                own = own.tobytes()
                pieces = []
                for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True), first):
                    parts = [b"".join(map(one, _lowered(part).split())) for part in slices(own[a:b])]
                    whole = b"".join([*parts, END.to_bytes(4, "little")])
                    pieces += [(i, k, whole[s : s + 4 * capacity]) for k, s in enumerate(range(0, len(whole), 4 * capacity))]
                rows_of, numbers, ids = zip(*pieces, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows_of)),
                        pa.array(numbers, pa.int32()),
                        pa.array([k * capacity for k in numbers], pa.int64()),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=schema.names,
                )
                first = last

    return docs.select(id, text).mapInArrow(rows, schema)


class Tightest:
    """A segment tree over capacities: which are open, and the least open one that is large enough."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.width)

    def set(self, capacity: int, is_open: bool) -> None:
        at = capacity + self.width
        self.open[at] = int(is_open)
        while at > 1:
            at >>= 1
            self.open[at] = self.open[2 * at] | self.open[2 * at + 1]

    def at_least(self, capacity: int) -> int | None:
        at = capacity + self.width
        while not self.open[at]:
            while at & 1:  # a right child: what is larger lies beside its parent
                at >>= 1
            if at == 0:
                return None
            at += 1
        while at < self.width:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.width


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing for ``counts`` pieces of each length.

    Equal lengths are interchangeable, so that the plan is made for runs of them:
    (length, first, last, sequence, each, offset) puts the pieces numbered first
    to last of a length, ``each`` to a sequence from ``offset`` on, into the
    sequences from ``sequence`` on. Every piece goes to the tightest open
    sequence. The work and the plan depend on the capacity, not on the counts.
    """
    tree, runs, steps, opened = Tightest(capacity), defaultdict(list), [], 0

    def put(room: int, first: int, last: int) -> None:
        if first <= last and room:
            runs[room].append((first, last))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens doesn't fit in {capacity}")
        placed, left = 0, counts[length]
        while left:
            room = tree.at_least(length)
            if room is None:
                room = capacity
                first, last = opened, opened + -(-left // (capacity // length)) - 1
                opened = last + 1
            else:
                first, last = runs[room].pop()
                tree.set(room, bool(runs[room]))
            fit = room // length
            each = min(fit, left)
            filled = min(last - first + 1, left // each)
            steps.append((length, placed, placed + filled * each - 1, first, each, capacity - room))
            put(room - each * length, first, first + filled - 1)
            put(room, first + filled, last)
            placed += filled * each
            left -= filled * each
    return steps


def pack(pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """The rows of ``pieces`` with ``sequence_id`` and ``offset``: their place in as few sequences as best fit finds.

    Only counts of lengths (at most ``capacity`` of them) come to the driver, and
    only the plan made of them (which depends on the capacity alone) is broadcast.
    Pieces of a length are numbered in ``SPREAD`` parts. ``order`` says which come
    first; rows alike in it are interchangeable. A null length, or one below 1,
    takes no place: both columns are null. An empty table stays empty. Columns
    named like the two new ones are replaced.
    """
    spark = pieces.sparkSession
    rows = stored(pieces.drop("sequence_id", "offset").withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(SPREAD))), "pieces")
    sized = rows.filter("length > 0").groupBy("length", "_part").agg(F.count("*").alias("_n"))
    parts = stored(sized, "lengths")
    counts = {r[0]: r[1] for r in parts.groupBy("length").agg(F.sum("_n")).collect()}
    plan = spark.createDataFrame(
        best_fit(counts, capacity), "length long, _first long, _last long, _sequence long, _each long, _offset long"
    )
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("length", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order))
    ranked = rows.withColumn("_row", number).join(before, ["length", "_part"], "left")
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_row") - 1)
    plan = F.broadcast(plan.withColumnRenamed("length", "_length"))
    placed = ranked.join(plan, F.expr("length = _length and _rank between _first and _last"), "left")
    at = F.col("_rank") - F.col("_first")
    return placed.select(
        *[c for c in rows.columns if c != "_part"],
        (F.col("_sequence") + F.floor(at / F.col("_each"))).alias("sequence_id"),
        (F.col("_offset") + at % F.col("_each") * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Documents as packed pieces with their token ids: what a training job reads, sorted by sequence and offset or not."""
    return pack(tokens(docs, path, capacity), capacity)


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The packed pieces of ``docs`` with a checksum in place of their ids."""
    pieces = tokens(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
