"""Ranked lexical search over all documents by bag deduplication.

Only terms of the items count for a score, so that a document is its bag: how
often it has each of these terms, and its length class m. Documents with equal
bags and m have equal scores. They are brought together by a hash, told apart by
their bytes, scored once, and expanded to their members in ascending order of id.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructType

from snapstar.llm.common import field, kind_of, raw
from snapstar.llm.terms import WORDS, alphabet, terms
from snapstar.session import stored

TOP = 20
#: Bytes of text and number of items that are asked in one pass over the documents; more are asked in further ones.
BLOCK, ITEMS = 1 << 20, 4096
#: Scores, and terms of items, that a task holds at a time.
SCORES = 1 << 20
TERMS = alphabet(WORDS)


class Items(NamedTuple):
    """The items of a block: their ids, and for each term the items that have it and how often."""

    ids: list
    index: dict[bytes, int]
    start: np.ndarray
    item: np.ndarray
    often: np.ndarray


def items_of(rows: list[tuple[object, str]]) -> Items:
    """Rows of an item are one item, whose terms are those of all of them."""
    asked: dict[object, Counter] = defaultdict(Counter)
    for id, text in rows:
        for part in terms(text.encode(), TERMS):
            asked[id].update(part)
    index = {term: i for i, term in enumerate(sorted(set().union(*asked.values())))}
    found = sorted((index[term], i, n) for i, counts in enumerate(asked.values()) for term, n in counts.items())
    term, item, often = np.array(found, np.int64).reshape(-1, 3).T
    return Items(list(asked), index, np.searchsorted(term, np.arange(len(index) + 1)), item, often)


def _bags(index: dict[bytes, int]) -> Callable:
    """Texts to bags: the numbers of the terms in ascending order, then how often each is there, 4 bytes a number."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = raw(batch.column(1))
            sizes, bags = [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                size, found = 0, Counter()
                for part in terms(data[a:b].tobytes(), TERMS):
                    size += len(part)
                    found.update(filter(index.__contains__, part))
                known = sorted((index[term], n) for term, n in found.items())
                sizes.append(size)
                bags.append(np.array(known, "<u4").reshape(-1, 2).T.tobytes())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())]
            found = pa.RecordBatch.from_arrays(columns, ["_id", "n", "bag"])
            yield found.filter(pa.array(np.array(sizes, np.int64) > 0))

    return rows


def _bag(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(data, "<u4").astype(np.int64).reshape(2, -1)
    return both[0], both[1]


def _totals(size: int) -> Callable:
    """Bags to (term, n): in how many documents a term is; term -1 counts documents, term -2 all their terms."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, docs, words = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            docs += len(batch)
            words += int(np.asarray(batch.column(0)).sum())
            found = [np.zeros(0, np.int64), *(_bag(x)[0] for x in batch.column(1).to_pylist())]
            counts += np.bincount(np.concatenate(found), minlength=size)
        some = np.flatnonzero(counts)
        columns = [np.concatenate([[-1, -2], some]), np.concatenate([[docs, words], counts[some]])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["term", "n"])

    return rows


def weight(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


def _scores(items: Items, weights: np.ndarray, m: np.ndarray, bags: list[bytes]) -> np.ndarray:
    """The score of each class (rows) for each item (columns), in 64-bit integers."""
    each = [_bag(b) for b in bags]
    size = np.array([len(t) for t, _ in each], np.int64)
    of = np.repeat(np.arange(len(bags)), size)
    term, often = (np.concatenate(x) for x in zip(*each, strict=True))
    worth = weights[term] * (1_000_000_000 * often // (1000 * often + 12 * m[of]))
    fan = items.start[term + 1] - items.start[term]
    found = np.zeros(len(bags) * len(items.ids), np.int64)
    ends = np.cumsum(fan)
    cut = np.searchsorted(ends, np.arange(0, int(ends[-1]) if len(ends) else 0, SCORES), "right")
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(term)], strict=True):
        entry = np.repeat(np.arange(a, b), fan[a:b])
        place = np.arange(len(entry)) + np.repeat(items.start[term[a:b]] - (ends[a:b] - fan[a:b]) + (ends[a] - fan[a] if a < b else 0), fan[a:b])
        np.add.at(found, of[entry] * len(items.ids) + items.item[place], worth[entry] * items.often[place])
    return found.reshape(len(bags), -1)


class _Best:
    """The best documents of each item so far: (item, score, null id, id)."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, np.int64)
        self.rows = np.zeros((4, 0), np.int64)

    def add(self, scores: np.ndarray, first: np.ndarray, count: np.ndarray, null: np.ndarray, id: np.ndarray) -> None:
        """Classes with their scores; the members of each are ``count`` rows from ``first`` on, in order."""
        if len(scores) > self.top:
            cut = len(scores) - self.top
            self.least = np.maximum(self.least, np.partition(scores, cut, 0)[cut])
        of, item = np.nonzero(scores >= self.least)
        score = scores[of, item]
        # A class beyond the first ones by its first member has no member among the first documents.
        kept = self._first(np.stack([item, score, null[first[of]], id[first[of]], of]))
        item, score, of = kept[0], kept[1], kept[4]
        many = count[of]
        row = np.arange(many.sum()) + np.repeat(first[of] - (np.cumsum(many) - many), many)
        members = np.stack([np.repeat(item, many), np.repeat(score, many), null[row], id[row]])
        self.rows = self._first(np.concatenate([self.rows, members], 1))
        full = np.bincount(self.rows[0], minlength=len(self.least)) >= self.top
        last = np.zeros(len(self.least), np.int64)
        last[self.rows[0]] = self.rows[1]  # the last of an item is its lowest
        self.least = np.where(full, np.maximum(self.least, last), self.least)

    def _first(self, rows: np.ndarray) -> np.ndarray:
        """The first ``top`` rows of each item, by score, nulls last, then id."""
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        starts = np.searchsorted(rows[0], rows[0])
        return rows[:, np.arange(rows.shape[1]) - starts < self.top]


def _rank(items: Items, weights: np.ndarray, top: int, schema: pa.Schema) -> Callable:
    """Members of classes, a class's rows together and numbered, to the best documents that a task has for each item."""
    step = max(1, SCORES // len(items.ids))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held = _Best(len(items.ids), top), None
        for batch in batches:
            if not len(batch):
                continue
            held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            starts = np.flatnonzero(held.column("_row").to_numpy() == 1)
            if len(starts) > step:
                # The last class may go on in the next batch.
                add(best, held.slice(0, int(starts[-1])))
                held = held.slice(int(starts[-1]))
        if held is not None:
            add(best, held)
        item, score, null, id = best.rows
        names = pa.array([items.ids[i] for i in item.tolist()], schema.field(0).type)
        ids = pa.array(np.ma.masked_array(id, null.astype(bool))) if len(id) else pa.array([], pa.int64())
        yield pa.RecordBatch.from_arrays([names, ids.cast(schema.field(1).type), pa.array(score, pa.int64())], schema=schema)

    def add(best: _Best, table: pa.Table) -> None:
        ids = table.column("_id").combine_chunks().cast(pa.int64())
        null, id = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(0).to_numpy()
        starts = np.flatnonzero(table.column("_row").to_numpy() == 1)
        counts = np.diff(np.append(starts, len(table)))
        bags, m = table.column("bag").take(pa.array(starts)).to_pylist(), table.column("m").to_numpy()[starts]
        for a in range(0, len(starts), step):
            scores = _scores(items, weights, m[a : a + step], bags[a : a + step])
            best.add(scores, starts[a : a + step], counts[a : a + step], null, id)

    return rows


def _block(docs: DataFrame, rows: list[tuple[object, str]], schema: StructType, top: int) -> DataFrame:
    """The best documents of each task for the items of a block; ``docs`` has _id and _text."""
    spark, items = docs.sparkSession, items_of(rows)
    if not items.index:
        return spark.createDataFrame([], schema)
    bags = stored(docs.mapInArrow(_bags(items.index), StructType([docs.schema["_id"], field("n", LongType())]).add("bag", "binary")), "lexical-bags")
    counts = bags.select("n", "bag").mapInArrow(_totals(len(items.index)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    held = {r["term"]: r["n"] for r in counts.collect()}  # a row for each term of the block
    total, words = held.get(-1, 0), held.get(-2, 0)
    weights = np.array([weight(total, held.get(t, 0)) for t in range(len(items.index))], np.int64)
    size = F.expr(f"75 + cast(n as decimal(20)) * {25 * total}BD div {max(words, 1)}")
    classes = bags.filter("octet_length(bag) > 0").select("_id", size.cast("long").alias("m"), "bag")
    key = [F.xxhash64("m", "bag").alias("hash"), "*"]
    of_class = Window.partitionBy("hash", "m", "bag").orderBy(F.asc_nulls_last("_id"))
    members = classes.select(*key).withColumn("_row", F.row_number().over(of_class)).filter(F.col("_row") <= top)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
    return members.select("_id", "m", "bag", "_row").mapInArrow(_rank(items, weights, top, arrow), schema)


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", block: int = BLOCK, most: int = ITEMS,
) -> DataFrame:
    """(item, rank, id, score): the ``top`` documents of each item with a score above 0, equal scores by ascending id.

    Terms are runs of letters, digits and all that is beyond ASCII, A-Z
    lower-cased. A term that ``df`` of N documents hold weighs
    floor(1000 ln((2N + 2) / (2 df + 1))); N has the documents with a term, L all
    their terms, n those of one, which has m = 75 + 25 n N div L. A score adds, for
    each term of the item, repeats included, weight * (1e9 tf div (1000 tf + 12 m)).

    Null or blank texts have no term: such documents are never found, such items
    find nothing. ``id`` is an integer; null ids come last. Rows that repeat are
    documents each; rows of the same item, a null one too, are one item. Other
    columns are left out; an empty table gives no rows.

    Each block of items, bounded in bytes and number, takes a pass over all
    documents. A class's first members by id come from a window that limits them
    before its exchange as well, so that of a group of copies a task sends
    ``top`` at most. A task keeps the best ``top`` of each item.
    """
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    asked = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).filter("octet_length(text) > 0")
    size, count = asked.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    blocks = max(1, -(-(size or 0) // block), -(-count // most))
    schema = StructType([field("item", kind_of(items, item)), field("_id", kind_of(docs, id)), field("score", LongType())])
    own = F.pmod(F.xxhash64("item"), F.lit(blocks))
    each = [_block(rows, [tuple(r) for r in asked.filter(own == b).collect()], schema, top) for b in range(blocks)]
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("_id"))
    ranked = reduce(DataFrame.unionByName, each).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(item), F.col("rank").cast(IntegerType()).alias("rank"), F.col("_id").alias(id), "score")


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
SQL = f"""
with split as (select row_number() over () as r, doc_id, {_TERMS} as terms from documents),
counted as (
    select r, doc_id, term, count(*)::bigint as tf from (select r, doc_id, unnest(terms) as term from split) t group by all),
sizes as (select r, len(terms)::bigint as n from split where len(terms) > 0),
totals as (select count(*)::bigint as docs, sum(n)::bigint as words from sizes),
held as (select term, count(*)::bigint as df from counted group by term),
asked as (select item_id, term, count(*)::bigint as q from (select item_id, unnest({_TERMS}) as term from benchmark) t group by all),
scores as (
    select item_id, r, doc_id, sum(q * floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint
        * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::bigint as score
    from asked join counted using (term) join held using (term) join sizes using (r), totals
    group by item_id, r, doc_id)
select item_id, rank, doc_id, score
from (select *, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank from scores where score > 0) t
where rank <= 20
"""
