"""Rows that are new since the target was last written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstar.schemas import DEFAULT_MARK


def high_water_mark(target: DataFrame, day: str = "snapshot_date", default: str = DEFAULT_MARK) -> Column:
    """The target's last day as a scalar subquery; ``default`` while it is empty."""
    last = target.agg(F.coalesce(F.max(day), F.lit(default).cast("date")).alias("mark"))
    return last.scalar()


def newer_rows(
    delta: DataFrame, target: DataFrame, day: str = "snapshot_date", default: str = DEFAULT_MARK
) -> DataFrame:
    """Rows after the target's last day; days that come late are left out.

    Spark runs the subquery once, before it lists the delta's files, so on a
    table partitioned by day older days are never read.
    """
    return delta.filter(F.col(day) > high_water_mark(target, day, default))


def rows_of_same_days(rows: DataFrame, delta: DataFrame, day: str = "snapshot_date") -> DataFrame:
    """The rows of the days that occur in ``delta``.

    The days, at most one date per calendar day, come as one array from a scalar
    subquery. As a filter on the partition column it prunes whole day folders
    before they are read, which a join would not.
    """
    days = delta.agg(F.collect_set(day).alias("days")).scalar()
    return rows.filter(F.array_contains(days, F.col(day)))
