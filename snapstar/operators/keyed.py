"""Work by key: one row per key, and rows whose key is absent elsewhere.

A key may hold any share of the rows. Ranking keeps one row per key, and Spark
applies that limit before the shuffle as well as after it, so a hot key sends
one row per map task. Distinct and grouped rows combine map-side likewise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstar.functions.columns import all_present


def one_per_key(
    rows: DataFrame, keys: list[str], order: list[Column] | None = None, ties: list[str] | None = None
) -> DataFrame:
    """The first row of each key by ``order``.

    The ``ties`` columns, by default all but the keys, break ties in ascending
    order, nulls first, so the result does not depend on how rows arrive.
    """
    ties = [c for c in rows.columns if c not in keys] if ties is None else ties
    window = Window.partitionBy(*keys).orderBy(*(order or []), *[F.col(c).asc() for c in ties])
    return rows.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_per_key(rows: DataFrame, keys: list[str], day: str = "snapshot_date") -> DataFrame:
    """The row of each key from its last day."""
    ties = [c for c in rows.columns if c not in [*keys, day]]
    return one_per_key(rows, keys, [F.col(day).desc()], ties)


def last_seen(rows: DataFrame, columns: list[str], day: str = "snapshot_date") -> DataFrame:
    """The distinct rows, each with its last day, in a hash aggregate that combines before the shuffle."""
    return rows.groupBy(*columns).agg(F.max(day).alias(day))


def dimension(rows: DataFrame, columns: list[str], day: str = "snapshot_date") -> DataFrame:
    """One row per first column, with the attributes it had last.

    Equal rows collapse into their last day first; only the distinct rows are then ranked.
    """
    return latest_per_key(last_seen(rows, columns, day), columns[:1], day).drop(day)


def upsert(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """The target with the rows of ``delta`` put in place of those with the same key; null keys match nothing, as in a merge.

    Both are ranked together, in one exchange, the delta's rows first and of them
    one by all columns. The target's rows of a key tie, so that all stay where
    the delta has none. A target that is merged into has each key once.
    """
    return upsert_marked(target, delta, keys).select(*target.columns)


def upsert_marked(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """``upsert`` with a column ``_new``, true in the rows of the delta."""
    new = F.col("_new")
    both = target.withColumn("_new", F.lit(False)).unionByName(delta.withColumn("_new", F.lit(True)))
    others = [c for c in target.columns if c not in keys]
    both = both.withColumn("_ties", F.when(new, F.struct(*others))).withColumn("_alone", ~all_present(keys) & new)
    window = Window.partitionBy(*keys, "_alone").orderBy(new.desc(), "_ties")
    ranked = both.select("*", F.rank().over(window).alias("_rank"), F.row_number().over(window).alias("_row"))
    return ranked.filter((F.col("_rank") == 1) & (~new | (F.col("_row") == 1))).select(*target.columns, "_new")


def insert_absent(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``delta`` to add to ``target``: one per key, none that is there already.

    Both sides have each key once by then, so no key is hot, and the join takes
    over the partitions in which the rows were ranked.
    """
    return one_per_key(delta, keys).join(target.select(*keys).distinct(), keys, "left_anti")


def supersede(previous: DataFrame, later: DataFrame, keys: list[str], day: str = "snapshot_date") -> DataFrame:
    """The last row of each key: of ``later`` days, or, for keys that these lack, of ``previous``; null equals null.

    ``previous`` has the columns of ``later`` but the day, which counts as before all others. One exchange.
    """
    before = previous.withColumn(day, F.lit("0001-01-01").cast("date"))
    return latest_per_key(later.select(*previous.columns, day).unionByName(before), keys, day).select(*previous.columns)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``.

    Distinct first: afterwards no key is hot, and the join reuses its partitions.
    """
    return left.distinct().join(right.distinct(), left.columns, "left_anti")


def set_union(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()
