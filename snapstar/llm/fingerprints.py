"""Document fingerprints from prefix polynomial hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from snapstar.llm.common import field, kind_of, partitions

#: A prime modulus, two bases, the code points in a span, the number of span classes.
PRIME = (1 << 31) - 1
BASES = (911_382_323, 972_663_749)
SPAN = 16
CLASSES = 64

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo the prime, at least; doubled whenever more are needed."""
    found = _powers.get(base, np.ones(1, np.uint64))
    while len(found) < n:
        found = np.concatenate([found, found * np.uint64(pow(base, len(found), PRIME)) % PRIME])
        _powers[base] = found
    return found


class PrefixHash:
    """Prefix hashes of a text's code points under two bases.

    Element i of an array is the sum of (code + 1) * base**j over all j < i, so
    that any span's hash is one difference, moved to a common power.
    """

    def __init__(self, text: str):
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.n = len(self.codes)
        self.prefix = []
        for base in BASES:
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum((self.codes + np.uint64(1)) * powers(base, self.n)[: self.n] % PRIME, out=sums[1:])
            sums %= PRIME
            self.prefix.append(sums)

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """The hash of [start, end): equal spans have equal hashes, wherever they are."""
        return tuple(
            (int(p[end]) + PRIME - int(p[start])) * pow(base, -start, PRIME) % PRIME
            for base, p in zip(BASES, self.prefix, strict=True)
        )

    def extension(self, start: int, other: PrefixHash, at: int) -> int:
        """How many code points from ``start`` on equal those of ``other`` from ``at`` on, by binary search."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(start, start + middle) == other.span(at, at + middle):
                low = middle
            else:
                high = middle - 1
        return low

    def spans(self, width: int) -> np.ndarray:
        """The hash of every span of ``width`` code points, in order, as one 62-bit number each."""
        count = self.n - width + 1
        both = []
        for base, p in zip(BASES, self.prefix, strict=True):
            back = powers(pow(base, -1, PRIME), count)[:count]
            both.append((p[width:] + np.uint64(PRIME) - p[:count]) % PRIME * back % PRIME)
        return both[0] << np.uint64(31) | both[1]

    def fingerprint(self) -> str:
        """Length and whole hash, a colon, and the least span hash of each class (4 hexadecimal digits, ---- for none).

        A text shorter than a span is one span; an empty text has none.
        """
        least = np.full(CLASSES, np.uint64(2**64 - 1))
        if self.n:
            mixed = self.spans(min(SPAN, self.n)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            np.minimum.at(least, (mixed >> np.uint64(58)).astype(np.intp), mixed << np.uint64(6))
        classes = "".join("----" if x == 2**64 - 1 else f"{(x >> 8) & 0xFFFF:04x}" for x in least.tolist())
        a, b = self.span(0, self.n)
        return f"{self.n:x}.{a:08x}{b:08x}:{classes}"


def likeness(one: str, other: str) -> float:
    """From two fingerprints, the share of the texts' spans in common, 2 |A and B| / (|A| + |B|) as estimated by classes."""
    if one == other:
        return 1.0
    a, b = one.partition(":")[2], other.partition(":")[2]
    pairs = [(a[i : i + 4], b[i : i + 4]) for i in range(0, 4 * CLASSES, 4)]
    either = sum(x != "----" or y != "----" for x, y in pairs)
    same = sum(x == y != "----" for x, y in pairs)
    share = same / either if either else 0.0
    return 2 * share / (1 + share)


def neighbours(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document and, in descending order of id, what it has in common with the next one and with an edited text.

    After the last document comes the first; a lone document is its own next.
    Nulls come last, as do lower text hashes among equal ids; rows equal in both
    are interchangeable. The edited text has the last half (rounded down) of the
    code points replaced by as many, or all, of the next document's first ones.
    Null texts are empty; other columns are left out; no rows give no rows.

    Ids are cut at quantiles into ranges, one text shuffle deals each range to a
    task of its own, sorted, and the first row of a range is sent to the range before it as
    well, so that a task streams through its rows and holds two texts at a time.
    What is collected is a row for each range.
    """
    rows = docs.select(F.col(id).alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = rows.withColumn("_hash", F.xxhash64("_text"))
    count = partitions(docs.sparkSession)
    cuts = docs.agg(F.percentile_approx(id, [i / count for i in range(1, count)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    above = sum([F.when(F.col("_id") < F.lit(c), 1).otherwise(0) for c in cuts], F.lit(0))
    rows = rows.withColumn("_range", F.when(F.col("_id").isNull(), len(cuts) + 1).otherwise(above))
    firsts = rows.groupBy("_range").agg(F.max(F.struct("_id", "_hash")).alias("f")).select("_range", "f.*").collect()
    firsts.sort(key=lambda r: r["_range"])
    before = [(r["_id"], r["_hash"], firsts[i - 1]["_range"]) for i, r in enumerate(firsts)]
    schema = StructType([field("_id", kind_of(docs, id)), field("_hash", LongType()), field("_before", LongType())])
    ahead = F.broadcast(docs.sparkSession.createDataFrame(before, schema))  # a row for each range
    same = rows["_id"].eqNullSafe(ahead["_id"]) & (rows["_hash"] == ahead["_hash"])
    both = rows.join(ahead, same, "left").select(rows["_id"], rows["_text"], rows["_hash"], "_range", "_before")
    places = F.array_compact(
        F.array(
            F.struct(F.col("_range").cast("long").alias("r"), F.lit(0).alias("late")),
            F.when(F.col("_before").isNotNull(), F.struct(F.col("_before").alias("r"), F.lit(1).alias("late"))),
        )
    )
    dealt = (
        both.withColumn("p", F.explode(places))
        .select("p.r", "p.late", "_id", "_hash", "_text")
        .repartitionById(len(cuts) + 2, F.col("r").cast("int"))
        .sortWithinPartitions("r", "late", F.desc_nulls_last("_id"), F.desc("_hash"))
        .select("r", "late", "_id", "_text")
    )
    return dealt.mapInArrow(_stream(id), _SCHEMA(kind_of(docs, id), id))


def _SCHEMA(kind, id: str) -> StructType:
    return StructType(
        [field(id, kind), field("n_chars", LongType()), field("edited_text_sha256", StringType())]
        + [field("fingerprint", StringType()), field("edited_fingerprint", StringType())]
        + [field("near_edited", DoubleType()), field("near_next", DoubleType())]
        + [field("same_as_edited", LongType()), field("same_as_next", LongType())]
    )


def _stream(id: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next one
        for batch in batches:
            out = []
            for r, late, key, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held is None or held[0] != r:
                    held = (r, key, text, PrefixHash(text), None) if not late else None
                    held = held and (*held[:4], held[3].fingerprint())
                    continue
                whole = PrefixHash(text)
                out.append(_compare(held, text, whole, mark := whole.fingerprint()))
                held = None if late else (r, key, text, whole, mark)
            yield pa.RecordBatch.from_pylist(out, _arrow(batch.schema.field(2).type))

    def _arrow(kind: pa.DataType) -> pa.Schema:
        names = _SCHEMA(LongType(), id).names
        kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
        return pa.schema(list(zip(names, kinds, strict=True)))

    def _compare(held: tuple, text: str, whole: PrefixHash, mark: str) -> dict:
        _, key, own, hashes, print_ = held
        half = len(own) // 2
        edited = own[: len(own) - half] + text[:half]
        other = PrefixHash(edited)
        changed = other.fingerprint()
        return {
            id: key,
            "n_chars": len(own),
            "edited_text_sha256": hashlib.sha256(edited.encode()).hexdigest(),
            "fingerprint": print_,
            "edited_fingerprint": changed,
            "near_edited": likeness(print_, changed),
            "near_next": likeness(print_, mark),
            "same_as_edited": hashes.extension(0, other, 0),
            "same_as_next": hashes.extension(0, whole, 0),
        }

    return rows


def digest(docs: DataFrame) -> DataFrame:
    return neighbours(docs).withColumnRenamed("edited_text_sha256", "edited_sha256")
