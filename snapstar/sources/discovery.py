"""Pages of a discovery listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.functions.columns import Day, between_days, safe_date
from snapstar.schemas import DISCOVERY_DDL
from snapstar.sources.raw import named_files


def read_pages(spark: SparkSession, root: str, day: Day = None, window: tuple[str, str] | None = None) -> DataFrame:
    """Landed pages of a day (all days when None): ``snapshot_date=D/[window=A_B/]page=N.json``."""
    folder = f"{root}/snapshot_date={day or '*'}"
    if window:
        folder += f"/window={window[0]}_{window[1]}"
    return named_files(spark, f"{folder}/page=*.json", DISCOVERY_DDL)


def missing_pages(pages: DataFrame) -> DataFrame:
    """Listings that are not complete: (folder, landed, total_pages), none if every page up to the last is there."""
    file = F.col("_metadata.file_path")
    number = F.regexp_extract(file, r"page=(\d+)", 1).cast("int")
    numbered = pages.select("total_pages", F.regexp_extract(file, "^(.*)/", 1).alias("folder"), number.alias("page"))
    found = numbered.groupBy("folder").agg(
        F.count_distinct(F.when(F.col("page") <= F.col("total_pages"), F.col("page"))).alias("landed"),
        F.max("total_pages").alias("total_pages"),
    )
    return found.filter("landed < total_pages")


def listed(pages: DataFrame) -> DataFrame:
    """The entries of all pages, one row each.

    A bare column would have Spark push a filter on it into the scan, which then
    generates code for that filter anew for each file.
    """
    return pages.select(F.inline(F.coalesce("results", F.array())))


def discovered_ids(entries: DataFrame) -> DataFrame:
    """The distinct ids of the entries."""
    return entries.select(F.col("id").cast("bigint").alias("movie_id")).filter("movie_id is not null").distinct()


def released_between(entries: DataFrame, first: Day, last: Day) -> DataFrame:
    """Entries released from ``first`` to ``last``, both included, oldest first.

    Adult and video entries are left out; a missing flag counts as unset.
    """
    unset = [~F.coalesce(F.col(flag), F.lit(False)) for flag in ("adult", "video")]
    released = safe_date(F.col("release_date"))
    in_window = between_days(released, F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
    return entries.filter(in_window & unset[0] & unset[1]).orderBy(released.asc(), F.col("id").asc())
