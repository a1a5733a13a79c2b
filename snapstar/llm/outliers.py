"""Quality rules: robust multivariate outliers by minimum covariance determinant. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstar.llm.common import GAP
from snapstar.session import stored

#: Base rules.
LEAST_WORDS, MOST_REPEATED = 10, 20
WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
#: Share of a group that an estimate rests on, concentration steps, and rows below which a group joins the common one.
SUBSET, STEPS, LEAST_ROWS = 0.75, 5, 50
#: Parts of a group that meet its values on their own.
SALTS = 32
#: The statistics that are compared, and the least standard deviation of each: what is alike in all documents of a
#: group says nothing about one of them.
STATISTICS = {"word_length": 0.06, "symbols": 0.25, "dup_lines": 0.35, "repeats": 0.35}
#: What documents are judged by: also words that follow themselves, which no window of ``WINDOW`` words need show.
JUDGED = {**STATISTICS, "doubled": 0.15}
#: Squared distance up to which a document is kept: the chi-square quantile of 1 - 1e-6 for the five of ``JUDGED``.
CUTOFF = 35.89
#: The medians of chi-square with four and five degrees of freedom.
MEDIAN, MEDIANS = 3.357, {4: 3.357, 5: 4.351}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is found once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(words: Column) -> Column:
    """How many words lie in a window of ``WINDOW`` words that is found twice or more in ``words``."""
    size = F.size(words)
    window = F.transform(
        F.sequence(F.lit(1), size - (WINDOW - 1)), lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(WINDOW)])
    )

    def positions(found: Column) -> Column:
        def same(x: Column, i: Column) -> Column:
            return (F.get(found, i - 1)["h"] == x["h"]) | (F.get(found, i + 1)["h"] == x["h"])

        repeated = F.filter(found, same)
        return F.array_sort(F.transform(repeated, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        each = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x)

    def count(hashes: Column) -> Column:
        found = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        all_of_them = let(let(found, positions), covered)
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), all_of_them).otherwise(0)

    return F.when(size > WINDOW, let(window, count)).otherwise(0)


def statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the base statistics of every whole text; null and empty texts have no words."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.array_remove(F.split(whole, GAP), "")
    row = docs.select(
        *keep,
        let(
            words,
            lambda w: F.struct(
                F.size(w).alias("n"),
                F.length(F.array_join(w, "")).alias("c"),
                _repeated(w).alias("r"),
                F.size(F.filter(w, lambda x, i: x == F.get(w, i + 1))).alias("d"),
            ),
        ).alias("_w"),
        F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("_l"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return row.select(
        *keep,
        F.col("_w.n").cast("long").alias("n_words"),
        F.col("_w.c").cast("long").alias("word_chars"),
        "n_symbols",
        F.col("_l.dup").cast("long").alias("n_dup_lines"),
        F.col("_w.r").cast("long").alias("n_repeat_words"),
        F.col("_l.n").cast("long").alias("n_lines"),
        F.col("_w.d").cast("long").alias("n_doubled"),
    ).withColumn("base_failed", failed)


def transformed() -> dict[str, Column]:
    """The statistics as compared: logarithms, and with a few words or lines added so that short texts vary less."""
    n = F.col("n_words").cast("double")
    return {
        "word_length": F.log((F.col("word_chars") + 6.0 * 30) / (n + 30)),
        "symbols": F.log1p(100 * F.col("n_symbols") / (n + 30)),
        "dup_lines": F.log1p(20 * F.col("n_dup_lines") / (F.col("n_lines") + 10.0)),
        "repeats": F.log1p(20 * F.col("n_repeat_words") / (n + 30)),
        "doubled": F.log1p(20 * F.col("n_doubled") / (n + 30)),
    }


def _moments(names: list[str]) -> list[Column]:
    pairs = [(a, b) for i, a in enumerate(names) for b in names[: i + 1]]
    return [F.avg(a).alias(f"m_{a}") for a in names] + [F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in pairs]


def _factor(least: dict[str, float]) -> list[Column]:
    """The Cholesky factor of the covariances, with the least deviations added to their diagonal."""
    names = list(least)
    found: dict[tuple[str, str], Column] = {}
    for i, a in enumerate(names):
        for j, b in enumerate(names[: i + 1]):
            rest = F.col(f"c_{a}_{b}") - sum((found[a, k] * found[b, k] for k in names[:j]), F.lit(0.0))
            found[a, b] = F.sqrt(rest + least[a] ** 2) if a == b else rest / found[b, b]
    return [value.alias(f"l_{a}_{b}") for (a, b), value in found.items()]


def _distance(names: list[str]) -> Column:
    """The squared Mahalanobis distance, by forward substitution."""
    found: dict[str, Column] = {}
    for i, a in enumerate(names):
        known = sum((F.col(f"l_{a}_{b}") * found[b] for b in names[:i]), F.lit(0.0))
        found[a] = (F.col(a) - F.col(f"m_{a}") - known) / F.col(f"l_{a}_{a}")
    return sum((x * x for x in found.values()), F.lit(0.0))


def _salt(columns: list[str]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS))


def _beside(rows: DataFrame, values: DataFrame, group: str) -> DataFrame:
    """Each row, which has a salt, with its group's values: a group meets them in ``SALTS`` parts, not as a whole."""
    salts = F.array(*[F.lit(i).cast("long") for i in range(SALTS)])
    return rows.join(values.withColumn("_salt", F.explode(salts)), [group, "_salt"])


def distances(rows: DataFrame, group: str = "group", least: dict[str, float] = STATISTICS) -> DataFrame:
    """``rows`` (with the columns of ``least``) and ``distance``, squared, from their group's robust centre.

    Medians and median deviations give a first centre. Then each concentration
    step takes the ``SUBSET`` of a group that lies nearest and finds its mean and
    covariance, which only lowers the determinant. At last the covariance is
    enlarged, never reduced, until the median distance is that of chi-square. All
    steps are aggregations with a row for each group, written to the shared
    folder; the rows themselves never gather.
    """
    names = list(least)
    given, rows = rows.columns, rows.withColumn("_salt", _salt(rows.columns))
    middle = stored(rows.groupBy(group).agg(*[F.percentile_approx(a, 0.5, 10_000).alias(f"m_{a}") for a in names]), "mcd")
    off = [F.percentile_approx(F.abs(F.col(a) - F.col(f"m_{a}")), 0.5, 10_000).alias(f"s_{a}") for a in names]
    spread = _beside(rows, middle, group).groupBy(group).agg(*off)
    diagonal = [
        (F.pow(1.4826 * F.col(f"s_{a}"), 2) if a == b else F.lit(0.0)).alias(f"c_{a}_{b}")
        for i, a in enumerate(names)
        for b in names[: i + 1]
    ]
    first = middle.join(spread, group).select(group, *[f"m_{a}" for a in names], *diagonal)
    centre = stored(first.select(group, *[f"m_{a}" for a in names], *_factor(least)), "mcd")
    for _ in range(STEPS):
        far = _beside(rows, centre, group).select(group, "_salt", *names, _distance(names).alias("_d"))
        cut = far.groupBy(group).agg(F.percentile_approx("_d", SUBSET, 10_000).alias("_cut"))
        near = _beside(far, cut, group).filter("_d <= _cut").groupBy(group).agg(*_moments(names))
        centre = stored(near.select(group, *[f"m_{a}" for a in names], *_factor(least)), "mcd")
    far = _beside(rows, centre, group).withColumn("_d", _distance(names))
    scale = stored(far.groupBy(group).agg(F.greatest(F.lit(1.0), F.percentile_approx("_d", 0.5, 10_000) / MEDIANS[len(names)]).alias("_scale")), "mcd")
    return _beside(far, scale, group).select(*given, (F.col("_d") / F.col("_scale")).alias("distance"))


def judge(docs: DataFrame, keep: list[str] | None = None, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``keep`` (the id), the base statistics, base_failed, distance and kept for every document.

    The base rules fail texts of few words or many repeated ones. The others are
    compared with those of their language and source (null is a value of its
    own; groups below ``LEAST_ROWS`` are taken together), and kept up to
    ``CUTOFF``. Base failures take no part in the estimates and have a null
    distance. A repeated row appears, and counts, as often as it is given.
    """
    keep = keep or ["doc_id"]
    own = [F.col(c).alias(f"_{i}") for i, c in enumerate(keep)]
    names = [f"_{i}" for i in range(len(keep))]
    one = F.concat_ws("\u0001", F.to_json(F.struct(F.col(lang).alias("l"), F.col(source).alias("s"))))
    read = docs.select(*own, F.col(text).alias("_text"), one.alias("_group"))
    base = stored(statistics(read, [*names, "_group"], "_text"), "statistics")
    passed = base.filter("not base_failed").withColumn("_salt", _salt(base.columns))
    counts = stored(passed.groupBy("_group").agg((F.count("*") >= LEAST_ROWS).alias("_own")), "mcd")
    rows = _beside(passed, counts, "_group").withColumn("group", F.when(F.col("_own"), F.col("_group")).otherwise(F.lit("")))
    rows = rows.select(*[c for c in base.columns if c != "_group"], "group", *[v.alias(k) for k, v in transformed().items()])
    found = distances(stored(rows, "mcd-rows"), least=JUDGED)
    columns = [F.col(n).alias(c) for n, c in zip(names, keep, strict=True)]
    columns += ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    bad = base.filter("base_failed").select(*columns, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return found.select(*columns, "distance", (F.col("distance") <= CUTOFF).alias("kept")).unionByName(bad)


def digest(docs: DataFrame) -> DataFrame:
    return judge(docs).drop("distance")
