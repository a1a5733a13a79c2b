"""How sources of a language differ in their use of terms: distances of pairs, and the terms a source has more of.

The value of a term in a source depends on two numbers alone, how often the
source and how often the language has it. Terms with the same two numbers are a
cell; cells are valued and ranked, and only those that reach the asked ranks are
expanded to terms again.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstar.llm.common import partitions, raw
from snapstar.llm.terms import LETTERS, alphabet, terms
from snapstar.session import stored

#: Documents of a language that keep a term, what is added to each count, and what a share is counted in.
LEAST, ADDED, UNIT = 30, 5, 1_000_000_000
TOP = 50
#: Counts that a task remembers before it sends them.
HELD = 400_000
#: Sources that are compared with one another at a time, and values that a task holds at a time for that.
SOURCES, VALUES = 256, 1 << 20
TERMS = alphabet(LETTERS)
COUNTS = "lang string, source string, term string, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs), added up in the task."""
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        data, at = raw(batch.column(2))
        for group, a, b in zip(zip(langs, sources, strict=True), at[:-1].tolist(), at[1:].tolist(), strict=True):
            seen = set()
            for part in terms(data[a:b].tobytes(), TERMS):
                counts[group].update(part)
                seen.update(part)
            held[group].update(seen)
        if sum(map(len, held.values())) >= HELD:
            yield from _sent(counts, held)
            counts.clear()
            held.clear()
    yield from _sent(counts, held)


def _sent(counts: dict[tuple, Counter], held: dict[tuple, Counter]) -> Iterator[pa.RecordBatch]:
    for (lang, source), found in counts.items():
        if found:
            docs = held[lang, source]
            columns = [pa.array([lang] * len(found), pa.string()), pa.array([source] * len(found), pa.string())]
            columns.append(pa.array([t.decode() for t in found], pa.string()))
            columns += [pa.array(list(found.values()), pa.int64()), pa.array([docs[t] for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + ADDED) / (total + ADDED * kept)), exactly, whatever the counts."""
    whole = (count + ADDED).cast("decimal(20)") * F.lit(UNIT).cast("decimal(10)")
    return F.call_function("div", whole, (total + ADDED * kept).cast("decimal(20)")) + 1


def kept_terms(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, source, term, n, total, first): terms that ``least`` documents of the language have, where the source has
    them; ``total`` is the language's count, ``first`` is 1 on one row of each term.

    ``rows`` is (lang, source, text) without nulls. Tasks add counts up before the
    first exchange, so that a common term costs a row for each source and task.
    """
    counts = rows.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    found = counts.select(
        "lang", "source", "term", "n",
        F.sum("n").over(of_term).alias("total"),
        F.sum("docs").over(of_term).alias("docs"),
        F.when(F.row_number().over(of_term.orderBy("source")) == 1, 1).otherwise(0).alias("first"),
    )
    return found.filter(F.col("docs") >= least).drop("docs")


def sizes(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, size, lang_size, terms, place, none): every group, the counts of its kept terms and the language's,
    how many terms the language keeps, its place among the language's sources, and the share of a term that it lacks."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.sum("first").alias("_terms"))
    groups = rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").fillna(0, ["size", "_terms"])
    of_lang = Window.partitionBy("lang")
    found = groups.select(
        "lang", "source", "size", F.sum("size").over(of_lang).alias("lang_size"), F.sum("_terms").over(of_lang).alias("terms"),
        (F.row_number().over(of_lang.orderBy("source")) - 1).alias("place"),
    )
    # A group of a language that keeps no term has no share to speak of.
    return found.withColumn("none", F.when(F.col("terms") > 0, share(F.lit(0), F.col("size"), F.col("terms"))).otherwise(0))


def distances(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, place, other, value, seen): for each two sources of a language the sum of the differences of ``seen`` terms;
    the other kept terms are in no source of the two's blocks.

    A language's terms are dealt to buckets by hash, and its sources to blocks of
    ``SOURCES``; a task holds the terms of a bucket, some at a time, for two
    blocks, and sends one sum for each two sources. Both orders are returned.
    """
    spark, buckets = kept.sparkSession, partitions(kept.sparkSession)
    known = kept.join(groups.select("lang", "source", "size", "terms", "place"), ["lang", "source"])
    values = known.select("lang", F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"), "term", "place", share(F.col("n"), F.col("size"), F.col("terms")).alias("value"))
    lacking = groups.filter("terms > 0").select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"), F.lit(None).cast("string").alias("term"), "place", F.col("none").alias("value"))
    own = F.floor(F.col("place") / SOURCES)
    last = groups.groupBy("lang").agg(F.floor(F.max("place") / SOURCES).alias("_last"))
    dealt = values.unionByName(lacking).join(last, "lang").withColumn("_with", F.explode(F.sequence(F.lit(0).cast("long"), "_last")))
    dealt = dealt.select("lang", "bucket", F.least(own, "_with").alias("lo"), F.greatest(own, "_with").alias("hi"), "term", F.col("place").cast("long").alias("place"), "value")
    key = ["lang", "bucket", "lo", "hi"]
    ready = dealt.repartition(buckets, *key).sortWithinPartitions(*key, F.asc_nulls_first("term"))
    sums = ready.mapInArrow(_differences(SOURCES), "lang string, place long, other long, value long, seen long")
    half = sums.groupBy("lang", "place", "other").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    sides = F.array(F.struct("place", "other"), F.struct(F.col("other").alias("place"), F.col("place").alias("other")))
    return half.select("lang", F.inline(sides), "value", "seen")


def _differences(sources: int) -> Callable:
    """Sorted rows (lang, bucket, lo, hi, term, place, value), those without a term first: sums for each two places."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, block = None, None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for lang, bucket, lo, hi, term, place, value in zip(*columns, strict=True):
                if (lang, bucket, lo, hi) != group:
                    if block:
                        yield block.sums(sources)
                    group, block = (lang, bucket, lo, hi), _Block(lang, lo, hi)
                block.add(term, place, value)
        if block:
            yield block.sums(sources)

    return rows


class _Block:
    """The sources of two blocks: the share of each in the terms at hand, a row for each term."""

    def __init__(self, lang: str, lo: int, hi: int):
        self.lang, self.lo, self.hi = lang, lo, hi
        self.places: list[int] = []
        self.none: list[int] = []
        self.column: dict[int, int] | None = None
        self.term = None

    def add(self, term: str | None, place: int, value: int) -> None:
        if term is None:
            self.places.append(place)
            self.none.append(value)
            return
        if self.column is None:
            self._open()
        if term != self.term:
            if self.used == len(self.rows):
                self._flush()
            self.term, self.used = term, self.used + 1
        self.rows[self.used - 1, self.column[place]] = value

    def _open(self) -> None:
        order = np.argsort(self.places)
        self.at, self.base = np.array(self.places)[order], np.array(self.none, np.int64)[order]
        self.column = {p: i for i, p in enumerate(self.at.tolist())}
        self.rows = np.tile(self.base, (max(1, VALUES // len(self.base)), 1))
        self.used, self.seen, self.total = 0, 0, np.zeros((len(self.base), len(self.base)), np.int64)

    def _flush(self) -> None:
        rows = self.rows[: self.used]
        for i in range(len(self.base) - 1):
            self.total[i, i + 1 :] += np.abs(rows[:, i + 1 :] - rows[:, i : i + 1]).sum(0)
        rows[:] = self.base
        self.used, self.seen = 0, self.seen + self.used

    def sums(self, sources: int = SOURCES) -> pa.RecordBatch:
        if self.column is None:
            self._open()
        self._flush()
        a, b = np.triu_indices(len(self.at), 1)
        if self.lo != self.hi:
            across = self.at[a] // sources != self.at[b] // sources  # each block has its own pairs elsewhere
            a, b = a[across], b[across]
        columns = [pa.array([self.lang] * len(a), pa.string()), pa.array(self.at[a], pa.int64())]
        columns += [pa.array(self.at[b], pa.int64()), pa.array(self.total[a, b], pa.int64())]
        columns.append(pa.array([self.seen] * len(a), pa.int64()))
        return pa.RecordBatch.from_arrays(columns, ["lang", "place", "other", "value", "seen"])


def pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of the language, the most different one first."""
    place = F.col("place").cast("long")
    own = groups.select("lang", place.alias("place"), "source", F.col("none").alias("_own"))
    every = groups.select("lang", place.alias("other"), F.col("source").alias("item"), F.col("none").alias("_other"), "terms")
    apart = F.col("value") + (F.col("terms") - F.col("seen")) * F.abs(F.col("_own") - F.col("_other"))
    named = distances(kept, groups).join(own, ["lang", "place"]).join(every, ["lang", "other"]).select("lang", "source", "item", apart.alias("value"))
    # Where a language keeps no term, all distances are 0 and no task has any.
    silent = every.filter("terms = 0").join(own, "lang").filter("place <> other").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.unionByName(silent).withColumn("rank", F.row_number().over(order))


def terms_ahead(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms of which a source has a larger share than its language, up to ``top``.

    Cells of equal value are merged; the number of terms in higher cells is where
    the ranks of a cell begin, so that cells beyond ``top`` are never expanded.
    """
    counted = kept.groupBy("lang", "source", "n", "total").agg(F.count("*").alias("many"))
    known = counted.join(groups.select("lang", "source", "size", "lang_size", "terms"), ["lang", "source"])
    ahead = share(F.col("n"), F.col("size"), F.col("terms")) - share(F.col("total"), F.col("lang_size"), F.col("terms"))
    cells = known.select("lang", "source", "n", "total", "many", ahead.alias("value")).filter("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # No more than ``top`` values of a source can matter: that limit goes before the exchange.
    first = cells.withColumn("_place", F.dense_rank().over(order)).filter(F.col("_place") <= top)
    up_to = F.sum("many").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.sum("many").over(Window.partitionBy("lang", "source", "value"))
    wanted = first.withColumn("before", up_to - same).filter(F.col("before") < top).drop("_place", "many")
    members = kept.select("lang", "source", "n", "total", "term").join(wanted, ["lang", "source", "n", "total"])
    within = Window.partitionBy("lang", "source", "value").orderBy("term")
    expanded = members.withColumn("_row", F.row_number().over(within)).filter(F.col("_row") <= top)
    ranked = expanded.withColumn("rank", (F.col("before") + F.col("_row")).cast("int")).filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows of all other sources, ``term`` rows up to rank ``top``.

    Terms are runs of letters and all that is beyond ASCII, A-Z lower-cased; a
    language keeps those in ``least`` of its documents or more. The share of a term
    is 1 + floor(1e9 (n + 5) / (N + 5 V)), N all counts of the V kept terms. A pair's
    value adds the differences of all kept terms, also those that neither source
    has; a term's is the difference to the language's share. Null texts,
    languages and sources are empty strings; a repeated row counts again; a
    source alone in its language has no pair; a source without terms has no
    ``term`` row; an empty table gives no rows; other columns are left out.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang), ("source", source), ("text", text))])
    kept = stored(kept_terms(rows, least), "divergence-terms")
    groups = stored(sizes(rows, kept), "divergence-groups")
    parts = {"pair": pairs(kept, groups), "term": terms_ahead(kept, groups, top)}
    each = [found.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, found in parts.items()]
    return reduce(DataFrame.unionByName, each)


SQL = """
with words as (
    select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
    from documents),
groups as (select distinct lang, source from words),
found as (select r, lang, source, unnest(terms) as term from words),
kept as (select lang, term, count(*)::hugeint as c from found group by lang, term having count(distinct r) >= 30),
langs as (select lang, sum(c)::hugeint as n, count(*)::hugeint as v from kept group by lang),
counted as (
    select g.lang, g.source, k.term, k.c as lang_c, count(f.r)::hugeint as c
    from groups g join kept k on k.lang = g.lang
    left join found f on f.lang = g.lang and f.source = g.source and f.term = k.term
    group by all),
sized as (select *, sum(c) over (partition by lang, source)::hugeint as n from counted),
shares as (
    select s.lang, s.source, s.term, s.c, 1 + (1000000000::hugeint * (s.c + 5)) // (s.n + 5 * l.v) as p,
        1 + (1000000000::hugeint * (s.lang_c + 5)) // (l.n + 5 * l.v) as q
    from sized s join langs l on l.lang = s.lang),
apart as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from shares a join shares b on b.lang = a.lang and b.term = a.term and b.source <> a.source group by all),
pairs as (
    select a.lang, a.source, b.source as item, coalesce(x.value, 0)::bigint as value
    from groups a join groups b on b.lang = a.lang and b.source <> a.source
    left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source),
ahead as (select lang, source, term as item, (p - q)::bigint as value from shares where c > 0 and p > q),
ranked as (
    select lang, source, 'pair' as part, item, value from pairs
    union all select lang, source, 'term', item, value from ahead)
select *
from (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from ranked) t
where part = 'pair' or rank <= 50
"""
