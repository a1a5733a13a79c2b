"""Token counts by section: whole documents encoded once, tokens dealt to sections by their spans."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from snapstar.llm.common import field, kind_of, raw

VOCABULARY = "byte_bpe_50k.tiktoken"
#: A text is encoded in parts of about so many bytes; they end before a space that follows a letter, where no token crosses.
PART = 1 << 20


def vocabulary(path: str | None = None) -> dict[bytes, int]:
    lines = open(path or public_tokenizers.path(VOCABULARY), "rb").read().splitlines()
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Spans:
    """Token ids of a text with the byte span of each."""

    def __init__(self, path: str | None = None, pattern: str | None = None):
        import tiktoken

        ranks = vocabulary(path)
        self.encoding = tiktoken.Encoding("own", pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def ends(self, text: bytes) -> np.ndarray:
        """The end of each token, in bytes. Tokens follow one another without a gap, so each starts where the last one ended."""
        found = [self.encoding.encode_to_numpy(part.decode(), allowed_special=set(), disallowed_special=()) for part in _parts(text)]
        return np.cumsum(self.lengths[np.concatenate(found or [np.zeros(0, np.uint32)]).astype(np.int64)])


def _parts(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > PART:
        cut = at + PART
        while 0 <= (cut := text.find(b" ", cut)) and not (text[cut - 1 : cut].isalpha() and text[cut + 1 : cut + 2].isalpha()):
            cut += 1
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:]


def attribute(ends: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each section [start, stop): the tokens that it gets, and how many of them cross its border.

    Sections are sorted and gapless. A token goes to the section that holds most
    of its bytes; of equal shares, to the earlier one.
    """
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first = np.searchsorted(stops, begins, "right")
    last = np.searchsorted(stops, ends, "left")
    owner = first.copy()
    crossing = np.flatnonzero(first != last)
    for t in crossing.tolist():  # a handful at most in a document line
        inside = range(first[t], last[t] + 1)
        shares = [min(ends[t], stops[s]) - max(begins[t], starts[s]) for s in inside]
        owner[t] = inside[int(np.argmax(shares))]
    return np.bincount(owner, minlength=len(stops)), np.bincount(owner[crossing], minlength=len(stops))


def count_tokens(docs: DataFrame, path: str | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, section, start, n_bytes, n_tokens, n_crossing) for every section of every text.

    A section is a line with its line feed, numbered from 0; ``start`` is its
    first byte. The whole text is encoded once, so that counts add up to its
    tokens, and a token over a border is allocated as ``attribute`` says.
    Null and empty texts have one empty section without tokens; a repeated row
    gives its sections again; other columns are left out.
    """
    schema = StructType([field(id, kind_of(docs, id))] + [field(n, LongType()) for n in "section start n_bytes n_tokens n_crossing".split()])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = Spans(path)
        for batch in batches:
            data, at = raw(batch.column(1))
            for low in range(0, len(batch), 1000):
                out = []
                for i in range(low, min(low + 1000, len(batch))):
                    own = data[at[i] : at[i + 1]]
                    stops = np.flatnonzero(own == 10) + 1
                    if not len(stops) or stops[-1] < len(own):
                        stops = np.append(stops, len(own))
                    starts = np.concatenate([[0], stops[:-1]])
                    tokens, crossing = attribute(spans.ends(own.tobytes()), starts, stops)
                    out.append((np.full(len(stops), i), np.arange(len(stops)), starts, stops - starts, tokens, crossing))
                which, *values = (np.concatenate(c) for c in zip(*out, strict=True))
                arrays = [batch.column(0).take(pa.array(which))] + [pa.array(v, pa.int64()) for v in values]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(id, text).mapInArrow(rows, schema)


def totals(counts: DataFrame, id: str = "doc_id") -> DataFrame:
    """A row for each id: its sections, bytes and tokens."""
    return counts.groupBy(id).agg(
        F.count("*").alias("n_sections"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens")
    )


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return count_tokens(docs)
