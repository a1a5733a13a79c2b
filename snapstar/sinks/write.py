"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.functions.columns import Day, day_literal, run_date

T = TypeVar("T")

DAY = "snapshot_date"
#: How tables are stored: texts and their keys repeat much, which Spark's default codec makes little use of.
PACKED = {"compression": "zstd"}


def balanced(rows: DataFrame, by: str = DAY) -> DataFrame:
    """Rows of a day together, in as many evenly sized tasks as they need.

    A plain repartition by day would put a whole day into one task; the
    rebalance hint lets adaptive execution split large days and join small ones.
    """
    return rows.hint("rebalance", by)


def append(rows: DataFrame, path: str) -> None:
    """Add the rows; running it twice doubles them."""
    rows.write.options(**PACKED).mode("append").parquet(path)


def append_days(rows: DataFrame, path: str) -> None:
    """Add the rows to their day folders; running it twice doubles them."""
    rows.write.options(**PACKED).mode("append").partitionBy(DAY).parquet(path)


def replace_days(rows: DataFrame, path: str, by: str = DAY) -> None:
    """Replace exactly the days that occur in the rows; running it again changes nothing.

    The rows may be read from the same table: Spark writes them aside first and
    swaps the day folders when all tasks are done.
    """
    rows.write.options(**PACKED, partitionOverwriteMode="dynamic").mode("overwrite").partitionBy(by).parquet(path)


def replace_day(rows: DataFrame, path: str, day: Day) -> None:
    """Make the table's ``day`` hold just these rows, none included; the rows must not be read from that day.

    Rows of other days are left out. Running it again changes nothing.
    """
    rows = rows.filter(F.col(DAY) == day_literal(day)).drop(DAY)
    rows.write.options(**PACKED).mode("overwrite").parquet(f"{path}/{DAY}={run_date(day)}")


def overwrite(rows: DataFrame, path: str, by: str | None = None) -> None:
    """Replace the whole table; the rows must not be read from it."""
    writer = rows.write.options(**PACKED, partitionOverwriteMode="static").mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


# How a daily table takes the rows of a day's run.
DAILY_MODES: dict[str, Callable[[DataFrame, str, Day], None]] = {
    "append": lambda rows, path, day: append_days(rows, path),
    "replace_day": replace_day,
}


def inspect(rows: DataFrame) -> None:
    """Print the schema and some rows, untruncated."""
    rows.printSchema()
    rows.show(truncate=False)


def at_once(jobs: list[Callable[[], T]], parallel: int = 4) -> list[T]:
    """Run independent writes, some at a time, so that one fills the cluster while another ends."""
    with ThreadPoolExecutor(parallel) as pool:
        running = [pool.submit(job) for job in jobs]
        return [job.result() for job in running]
