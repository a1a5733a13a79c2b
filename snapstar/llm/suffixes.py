"""Repeated passages by blockwise suffix sorting with a difference cover.

Every suffix counts by its first ``WINDOW`` bytes. Sorting all of them at once
would move the text many times over, so that suffixes are sorted a bucket at a
time, and the difference cover says beforehand which of them can tie at all:

1. The cover: of ``PERIOD`` successive positions, those in ``COVER`` are sampled.
   Any two positions have an offset below ``PERIOD`` at which both are sampled;
   where two suffixes agree in ``WINDOW`` bytes, the samples there agree in
   ``WINDOW - PERIOD + 1``. Sorting the samples by these bytes, a bucket at a
   time, ranks them; what matters of a rank is whether another document ties.
2. The suffixes: one that covers no tied sample is alone, so that only the others
   are sorted, again a bucket at a time. Those that tie by 64 bits are sorted once
   more by 64 further ones, and the least document of each tie found.
3. The cut: each document drops what its later ones of the ties cover.

Text travels in chunks of successive ids, so that a chunk needs to know only
which of its suffixes an earlier chunk has as well. Within a chunk windows are
compared by their bytes, across chunks by two hashes of 64 bits: of m windows,
some tie falsely with a chance of m^2 / 2^129. A false tie among the samples, or
by the first hash alone, costs a little work and nothing else.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.llm.common import kind_of, partitions, raw, released
from snapstar.session import stored

WINDOW = 50
#: A perfect difference set; each difference modulo the period occurs once.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Bytes of text that a task holds at a time (a longer document is held whole), and keys in a bucket.
CHUNK, BUCKET = 4 << 20, 1 << 20
KNOTS = 256
#: Parts in which the copies of a text are told the least id among them.
PARTS = 32
MESSAGE = "chunk long, kind int, bucket long, data binary"
TEXT, COPY, TIED, SHARED, EARLIER = 0, 1, 2, 3, 4
LAST = np.iinfo(np.int64).max


class Layout(NamedTuple):
    """How ids are cut into chunks and keys into buckets; a few numbers, whatever the input."""

    knots: np.ndarray
    per: int
    sample_bits: int
    bucket_bits: int

    def chunk(self, ids: np.ndarray) -> np.ndarray:
        """Ascending with the id; a null id (``LAST``) comes after all."""
        if not len(self.knots):
            return np.zeros(len(ids), np.int64)
        at = np.clip(np.searchsorted(self.knots, ids, "right") - 1, 0, max(len(self.knots) - 2, 0))
        low, high = self.knots[at].astype(float), self.knots[np.minimum(at + 1, len(self.knots) - 1)].astype(float)
        inside = np.floor((ids - low) / np.maximum(high - low, 1) * self.per)
        found = at * self.per + np.clip(inside, 0, self.per - 1).astype(np.int64)
        return np.where(ids == LAST, len(self.knots) * self.per, found)


def layout(docs: DataFrame, id: str, text: str, chunk: int = CHUNK) -> Layout:
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, -(-total // chunk))
    knots = min(chunks, KNOTS)
    cuts = docs.agg(F.percentile_approx(id, [i / knots for i in range(knots + 1)], 10_000)).first()[0] or []
    size = max(2, math.ceil(math.log2(total + 2)))
    bits = max(1, math.ceil(math.log2(total * len(COVER) / PERIOD / BUCKET + 1)))
    return Layout(np.unique(np.array(cuts, np.int64)), -(-chunks // knots), min(64, size + 7), bits)


def hashes(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes (8 or more) from each position on."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    found = np.full(len(at), np.uint64(width))
    for offset in [*range(0, width - 8, 8), width - 8]:
        found = (found ^ words[at + offset]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    found *= np.uint64(0xD6E8FEB86659FD93)
    return found ^ found >> np.uint64(32)


def checks(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Another 64-bit hash of the windows, of other steps than ``hashes``."""
    found = np.full(len(at), np.uint64(0x243F6A8885A308D3))
    for word in reversed(_words(data, at)):
        word = (word ^ word >> np.uint64(32)) * np.uint64(0xC2B2AE3D27D4EB4F)
        found = (found ^ word ^ word >> np.uint64(31)) * np.uint64(0xFF51AFD7ED558CCD)
        found ^= found >> np.uint64(33)
    found *= np.uint64(0xC4CEB9FE1A85EC53)
    return found ^ found >> np.uint64(29)


def _words(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The bytes of the windows, eight at a time; the last ones overlap."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    return [words[at + offset] for offset in [*range(0, WINDOW - 8, 8), WINDOW - 8]]


def differ(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the windows at ``a`` and ``b`` differ, by their bytes."""
    return np.any([x != y for x, y in zip(_words(data, a), _words(data, b), strict=True)], axis=0)


def pack(values: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


class Chunk:
    """The documents of a chunk, by id: their bytes in one array, and where each starts."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, data: np.ndarray, copies: set[tuple[int, int]] = frozenset()):
        """``copies``, (id, mark) of a text, are left out."""
        order = np.argsort(ids, kind="stable")
        ends = np.cumsum(lengths)
        if copies:
            some = np.isin(ids[order], np.array([i for i, _ in copies], np.int64))
            known = [i for i in order[some].tolist() if (int(ids[i]), _mark(data[ends[i] - lengths[i] : ends[i]].tobytes())) in copies]
            order = order[~np.isin(order, np.array(known, np.int64))]
        self.ids, self.lengths = ids[order], lengths[order]
        parts = [data[ends[i] - lengths[i] : ends[i]] for i in order]
        self.data = np.concatenate([*parts, np.zeros(WINDOW, np.uint8)])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """The positions in the cover that have enough bytes after them, and the document of each."""
        width = WINDOW - PERIOD + 1
        longest = int(self.lengths.max(initial=0))
        cover = (np.arange(0, longest + PERIOD, PERIOD)[:, None] + np.array(COVER)).ravel()
        counts = np.searchsorted(cover, self.lengths - width, "right")
        places = [cover[:n] + s for n, s in zip(counts.tolist(), self.starts[:-1].tolist(), strict=True) if n]
        return np.concatenate([*places, np.zeros(0, np.int64)]), np.repeat(np.arange(len(counts)), counts)

    def sampled(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, doc = self.samples()
        return at, doc, hashes(self.data, at, WINDOW - PERIOD + 1) >> np.uint64(64 - bits)

    def suffixes(self, bits: int, tied: np.ndarray) -> Suffixes:
        """Those whose window covers a sample that ties."""
        at, doc, keys = self.sampled(bits)
        place = np.minimum(np.searchsorted(tied, keys), max(len(tied) - 1, 0))
        hit = tied[place] == keys if len(tied) else np.zeros(len(keys), bool)
        at, doc = at[hit], doc[hit]
        low = np.maximum(at - PERIOD + 1, self.starts[doc])
        high = np.minimum(at, self.starts[doc + 1] - WINDOW) + 1
        ok = low < high
        size = len(self.data) + 1
        steps = np.bincount(low[ok], minlength=size) - np.bincount(high[ok], minlength=size)
        return Suffixes(self, np.flatnonzero(np.cumsum(steps, out=steps) > 0))


class Suffixes:
    """Some suffixes of a chunk, sorted by their windows; ``keys`` and ``first`` have each window once."""

    def __init__(self, chunk: Chunk, at: np.ndarray):
        self.chunk = chunk
        keys = hashes(chunk.data, at, WINDOW)
        order = np.argsort(keys, kind="stable")
        found, self.at = keys[order], at[order]
        new = np.concatenate([[True], found[1:] != found[:-1]]) if len(found) else np.zeros(0, bool)
        again = np.flatnonzero(~new)
        if differ(chunk.data, self.at[again - 1], self.at[again]).any():
            # Other bytes under the same key: sorted by the bytes too.
            order = np.lexsort((*_words(chunk.data, at), keys))
            found, self.at = keys[order], at[order]
            new[1:] = (found[1:] != found[:-1]) | differ(chunk.data, self.at[:-1], self.at[1:])
        self.keys, self.of, self.first = found[new], np.cumsum(new) - 1, self.at[new]
        ids = chunk.ids[np.searchsorted(chunk.starts, self.at, "right") - 1]
        # The least id of a window comes first, for the sort is stable and documents are in order.
        self.later = ids > ids[new][self.of] if len(found) else np.zeros(0, bool)

    def covered(self, earlier: np.ndarray) -> np.ndarray:
        """Which bytes of the chunk to remove; ``earlier``: of the keys, those that an earlier chunk has."""
        gone = self.at[self.later | earlier[self.of]] if len(self.at) else self.at
        size = len(self.chunk.data) + 1
        steps = np.bincount(gone, minlength=size) - np.bincount(gone + WINDOW, minlength=size)
        return np.cumsum(steps) > 0


def _ids(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), int(LAST)).to_numpy(zero_copy_only=False)


def _by_chunk(batch: pa.RecordBatch, plan: Layout) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(chunk, ids, lengths, bytes) for each chunk that has rows in a batch."""
    ids, (data, at) = _ids(batch.column(0)), raw(batch.column(1))
    chunk = plan.chunk(ids)
    for c in np.unique(chunk):
        own = np.flatnonzero(chunk == c)
        parts = [data[at[i] : at[i + 1]] for i in own]
        yield int(c), ids[own], at[own + 1] - at[own], np.concatenate(parts)


def _messages(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    chunk, kind, bucket, data = zip(*rows, strict=True) if rows else ((), (), (), ())
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    arrays = [pa.array(v, k) for v, k in zip((chunk, kind, bucket, data), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["chunk", "kind", "bucket", "data"])


def _buckets(keys: np.ndarray, bits: int, plan: Layout) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, end) of sorted keys of so many bits."""
    if len(keys):
        own = keys >> np.uint64(bits - min(plan.bucket_bits, bits - 1))
        cuts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield int(own[a]), a, b


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[tuple[int, int, int, bytes]]]]:
    """Successive messages with the same value of ``column``."""
    key, held = None, []
    for batch in batches:
        at = batch.schema.get_field_index(column)
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[at] != key:
                if held:
                    yield key, held
                key, held = row[at], []
            held.append(row)
    if held:
        yield key, held


def _dealt(messages: DataFrame, by: str) -> DataFrame:
    return messages.repartition(partitions(messages.sparkSession), by).sortWithinPartitions(by, "kind", "chunk", "bucket")


def _sample(plan: Layout) -> Callable:
    """Texts to messages: the sampled keys of each chunk by bucket, the tied ones first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, *parts in _by_chunk(batch, plan):
                _, doc, keys = Chunk(*parts).sampled(plan.sample_bits)
                order = np.argsort(keys, kind="stable")
                keys, doc = keys[order], doc[order]
                new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(keys)) - 1
                within = doc[first] != doc[last] if len(keys) else new
                keys = keys[new]
                out = []
                for bucket, a, b in _buckets(keys, plan.sample_bits, plan):
                    known = np.packbits(within[a:b]).tobytes()
                    out.append((c, 0, bucket, len(known).to_bytes(8, "little") + known + pack(keys[a:b])))
                yield _messages(out)

    return rows


def _rank(plan: Layout) -> Callable:
    """A bucket of samples at a time: the keys of each chunk that tie with another document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in _runs(batches, "bucket"):
            keys, tied, chunk = [], [], []
            for c, _, _, data in held:
                size = int.from_bytes(data[:8], "little")
                keys.append(unpack(data[8 + size :]))
                tied.append(np.unpackbits(np.frombuffer(data[8 : 8 + size], np.uint8), count=len(keys[-1])).astype(bool))
                chunk.append(np.full(len(keys[-1]), c))
            key, known, chunk = np.concatenate(keys), np.concatenate(tied), np.concatenate(chunk)
            order = np.argsort(key, kind="stable")
            key, known, chunk = key[order], known[order], chunk[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            of = np.cumsum(new) - 1
            many = (np.bincount(of) > 1) | (np.bincount(of, weights=known) > 0)
            key, chunk = key[many[of]], chunk[many[of]]
            order = np.argsort(chunk, kind="stable")
            key, chunk = key[order], chunk[order]
            cuts = np.concatenate([[0], np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, [len(chunk)]]) if len(chunk) else [0]
            own = [(int(chunk[a]), TIED, bucket, pack(np.unique(key[a:b]))) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield _messages(own)

    return rows


def _copies(plan: Layout) -> Callable:
    """Copies to messages: their ids and the start of their hashes, by chunk."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = _ids(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            chunk = plan.chunk(ids)
            own = [(c, np.flatnonzero(chunk == c)) for c in np.unique(chunk).tolist()]
            yield _messages([(c, COPY, 0, np.concatenate([ids[k], marks[k]]).astype("<i8").tobytes()) for c, k in own])

    return rows


def _mark(text: bytes) -> int:
    """The first 60 bits of a text's hash, as the marks of copies have them."""
    return int(hashlib.sha256(text).hexdigest()[:15], 16)


def _texts(plan: Layout) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for c, ids, lengths, data in _by_chunk(batch, plan):
                head = np.concatenate([[len(ids)], ids, lengths]).astype("<i8").tobytes()
                out.append((c, TEXT, 0, zstandard.compress(head + data.tobytes(), 3)))
            yield _messages(out)

    return rows


def _read(held: list[tuple[int, int, int, bytes]], plan: Layout) -> tuple[Chunk, Suffixes, list[tuple[int, int, int, bytes]]]:
    """A chunk's documents, its suffixes that can tie, and the messages about these."""
    ids, lengths, data, tied, copies, rest = [], [], [], [np.zeros(0, np.uint64)], set(), []
    for message in held:
        if message[1] == TEXT:
            whole = zstandard.decompress(message[3])
            n = int.from_bytes(whole[:8], "little")
            numbers = np.frombuffer(whole, "<i8", 2 * n, 8)
            ids.append(numbers[:n])
            lengths.append(numbers[n:])
            data.append(np.frombuffer(whole, np.uint8, offset=8 + 16 * n))
        elif message[1] == COPY:
            both = np.frombuffer(message[3], "<i8").reshape(2, -1)
            copies.update(zip(both[0].tolist(), both[1].tolist(), strict=True))
        elif message[1] == TIED:
            tied.append(unpack(message[3]))
        else:
            rest.append(message)
    none = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
    chunk = Chunk(*(np.concatenate(a + b) for a, b in zip(none, (ids, lengths, data), strict=True)), copies)
    return chunk, chunk.suffixes(plan.sample_bits, np.concatenate(tied)), rest


def _windows(plan: Layout) -> Callable:
    """Chunks to messages: the windows of each by bucket."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, held in _runs(batches, "chunk"):
            keys = _read(held, plan)[1].keys
            yield _messages([(c, 0, bucket, pack(keys[a:b])) for bucket, a, b in _buckets(keys, 64, plan)])

    return rows


def _shared(plan: Layout) -> Callable:
    """A bucket of suffixes at a time: which keys of a chunk, in order, are found again."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in _runs(batches, "bucket"):
            keys = [unpack(message[3]) for message in held]
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            same = np.concatenate([[False], key[order][1:] == key[order][:-1], [False]])
            shared = np.empty(len(key), bool)
            shared[order] = same[1:] | same[:-1]
            yield _answers(held, SHARED, bucket, keys, shared)

    return rows


def _checks(plan: Layout) -> Callable:
    """Chunks to messages: the shared windows of each by bucket, with both hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, held in _runs(batches, "chunk"):
            _, suffixes, rest = _read(held, plan)
            shared = _known(rest, SHARED, suffixes.keys, plan)
            keys, check = suffixes.keys[shared], checks(suffixes.chunk.data, suffixes.first[shared])
            yield _messages([(c, 0, bucket, (b - a).to_bytes(8, "little") + check[a:b].tobytes() + pack(keys[a:b])) for bucket, a, b in _buckets(keys, 64, plan)])

    return rows


def _least(plan: Layout) -> Callable:
    """A bucket of shared suffixes at a time: which of a chunk, in order, an earlier chunk has as well."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in _runs(batches, "bucket"):
            held.sort()
            both = [_pair(message[3]) for message in held]
            key, check = (np.concatenate(x) for x in zip(*both, strict=True))
            order = np.lexsort((check, key))  # equal ones stay in the order of their chunks
            key, check = key[order], check[order]
            earlier = np.empty(len(key), bool)
            earlier[order] = np.concatenate([[False], (key[1:] == key[:-1]) & (check[1:] == check[:-1])])
            yield _answers(held, EARLIER, bucket, [k for k, _ in both], earlier)

    return rows


def _pair(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    return unpack(data[8 + 8 * n :]), np.frombuffer(data, "<u8", n, 8)


def _answers(held: list[tuple[int, int, int, bytes]], kind: int, bucket: int, keys: list[np.ndarray], bits: np.ndarray) -> pa.RecordBatch:
    """A bit for each key of each message, to the chunk that sent it."""
    parts = np.split(bits, np.cumsum([len(k) for k in keys])[:-1])
    return _messages([(m[0], kind, bucket, zstandard.compress(np.packbits(p).tobytes(), 1)) for m, p in zip(held, parts, strict=True)])


def _known(rest: list[tuple[int, int, int, bytes]], kind: int, keys: np.ndarray, plan: Layout) -> np.ndarray:
    """The bits that came back for sorted keys."""
    known = {message[2]: message[3] for message in rest if message[1] == kind}
    found = np.zeros(len(keys), bool)
    for bucket, a, b in _buckets(keys, 64, plan):
        bits = np.frombuffer(zstandard.decompress(known[bucket]), np.uint8)
        found[a:b] = np.unpackbits(bits, count=b - a)
    return found


def _cut(plan: Layout) -> Callable:
    """Chunks to results: id, n_bytes, n_removed, n_spans, kept_sha256, and the spans as flat (start, end) bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _runs(batches, "chunk"):
            chunk, suffixes, rest = _read(held, plan)
            earlier = _known(rest, SHARED, suffixes.keys, plan)
            earlier[earlier] = _known(rest, EARLIER, suffixes.keys[earlier], plan)
            gone = suffixes.covered(earlier)
            out = []
            for id, a, b in zip(chunk.ids.tolist(), chunk.starts[:-1].tolist(), chunk.starts[1:].tolist(), strict=True):
                own = gone[a:b]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                kept = chunk.data[a:b] if not len(edge) else chunk.data[a:b][~own]
                out.append((None if id == LAST else id, b - a, int(own.sum()), len(edge) // 2, hashlib.sha256(kept.tobytes()).hexdigest(), edge))
            id, n, removed, spans, sha, edges = zip(*out, strict=True) if out else ((),) * 6
            arrays = [pa.array(v, pa.int64()) for v in (id, n, removed, spans)]
            arrays += [pa.array(sha, pa.string()), pa.array(edges, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return rows


RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans): what each document repeats of those with smaller ids.

    A byte is removed if a string of ``WINDOW`` bytes that covers it also starts
    in a document with a smaller id, judged on the texts as given. ``spans`` are
    the removed runs as start, end, start, end … in bytes. ``id`` is an integer;
    a null one is larger than all others, and rows with equal ids don't count
    for one another. Null texts are empty. A repeated row appears as often as it
    is given; other columns are left out; an empty table gives no rows.

    Exact copies are settled by their hash: all but those with the least id are
    removed whole, and take no part in the sorting. What a step needs of the one
    before it is written to the shared folder.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    marks = stored(rows.select("id", F.octet_length("text").cast("long").alias("n"), F.sha2("text", 256).alias("sha")), "suffix-marks")
    least = marks.groupBy("sha").agg(F.min("id").alias("least"), F.count("*").alias("_n")).filter("_n > 1")
    # A group of copies may hold any share of the rows: its members meet the least id in parts.
    least = least.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    parted = marks.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int"))
    copies = parted.join(least, ["sha", "_part"]).filter("id > least or (id is null and least is not null)").select("id", "n", "sha")
    copies = stored(copies, "suffix-copies")
    again = copies.select("id", F.conv(F.substring("sha", 1, 15), 16, 10).cast("long").alias("mark"))
    plan = layout(rows, "id", "text", chunk)
    tied = stored(_dealt(rows.mapInArrow(_sample(plan), MESSAGE), "bucket").mapInArrow(_rank(plan), MESSAGE), "suffix-ties")
    released(spark)
    texts = rows.mapInArrow(_texts(plan), MESSAGE).unionByName(again.mapInArrow(_copies(plan), MESSAGE)).unionByName(tied)
    windows = _dealt(texts, "chunk").mapInArrow(_windows(plan), MESSAGE)
    texts = texts.unionByName(stored(_dealt(windows, "bucket").mapInArrow(_shared(plan), MESSAGE), "suffix-shared"))
    released(spark)
    again = _dealt(texts, "chunk").mapInArrow(_checks(plan), MESSAGE)
    earlier = stored(_dealt(again, "bucket").mapInArrow(_least(plan), MESSAGE), "suffix-earlier")
    released(spark)
    found = _dealt(texts.unionByName(earlier), "chunk").mapInArrow(_cut(plan), RESULT)
    all_of_it = F.col("n") >= WINDOW
    whole = copies.select(
        "id",
        F.col("n").alias("n_bytes"),
        F.when(all_of_it, F.col("n")).otherwise(0).alias("n_removed"),
        F.when(all_of_it, 1).otherwise(0).cast("long").alias("n_spans"),
        F.when(all_of_it, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(all_of_it, F.array(F.lit(0).cast("long"), F.col("n"))).otherwise(F.array().cast("array<long>")).alias("spans"),
    )
    named = found.unionByName(whole)
    return named.select(F.col("id").cast(kind_of(docs, id)).alias(id), *[c for c in named.columns if c != "id"])


def digest(docs: DataFrame) -> DataFrame:
    return repeats(docs).drop("spans")
