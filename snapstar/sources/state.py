"""The tracked ids, kept as a log: a sorted base, and for each run the ids that it added.

A run writes what is new and nothing else. After ``MERGED`` of them the log is
merged into a new base. Bases are numbered ``version=N`` folders, what was added
to one is in ``delta=N-M`` folders beside it; readers take the last base with all
that was added to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.sources.tables import partition_values, remove

IDS_DDL = "movie_id bigint"
#: Bases that stay, so that readers of the one before the last can finish, and additions after which there is a new one.
KEPT, MERGED = 5, 32


def load_ids(spark: SparkSession, path: str) -> DataFrame:
    """The tracked ids; none when nothing was saved yet."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], IDS_DDL)
    folders = [f"{path}/version={versions[-1]}", *(f"{path}/delta={d}" for d in _deltas(spark, path, versions[-1]))]
    return spark.read.schema(IDS_DDL).parquet(*folders)


def save_ids(spark: SparkSession, ids: DataFrame, path: str) -> str:
    """Write the distinct ids, sorted, as the next base; returns its folder. The last ``KEPT`` bases stay."""
    versions = _versions(spark, path)
    folder = f"{path}/version={(versions or [0])[-1] + 1}"
    ids.select("movie_id").distinct().orderBy("movie_id").write.mode("overwrite").parquet(folder)
    for old in versions[: 1 - KEPT]:
        for delta in _deltas(spark, path, old):
            remove(spark, f"{path}/delta={delta}")
        remove(spark, f"{path}/version={old}")
    return folder


def add_ids(spark: SparkSession, new: DataFrame, path: str) -> str:
    """Add ids that are not tracked yet; returns the folder written. The base is read and written once in ``MERGED`` runs only.

    The new ids are rebalanced into few files, so that what finds them keeps its tasks.
    """
    versions = _versions(spark, path)
    if not versions:
        return save_ids(spark, new, path)
    deltas = _deltas(spark, path, versions[-1])
    last = int(deltas[-1].partition("-")[2]) if deltas else 0
    if len(deltas) + 1 >= MERGED:
        return save_ids(spark, load_ids(spark, path).unionByName(new.select("movie_id")), path)
    folder = f"{path}/delta={versions[-1]}-{last + 1}"
    new.select("movie_id").hint("rebalance").write.mode("overwrite").parquet(folder)
    return folder


def known_ids(tracked: DataFrame, ids: DataFrame) -> DataFrame:
    """Those of a day's ids that are tracked.

    The log is read within the bounds of the ids, which its base is sorted by, and
    streams past them: no tracked id is shuffled while the day's ids can be broadcast.
    """
    bounds = ids.agg(F.min("movie_id").alias("low"), F.max("movie_id").alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    return tracked.filter(F.col("movie_id").between(low, high)).join(ids, "movie_id", "left_semi").distinct()


def _versions(spark: SparkSession, path: str) -> list[int]:
    """By listing the folder; no version but the one that is wanted is opened."""
    return sorted(int(v) for v in partition_values(spark, path, "version"))


def _deltas(spark: SparkSession, path: str, version: int) -> list[str]:
    """What was added to a base, in order."""
    own = [d for d in partition_values(spark, path, "delta") if d.startswith(f"{version}-")]
    return sorted(own, key=lambda d: int(d.partition("-")[2]))


def read_id_array(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a JSON array of integers, one line or many.

    Read by line, so that a long array is split over tasks.
    """
    parts = spark.read.text(path).select(F.explode(F.split("value", ",")).alias("part"))
    digits = F.regexp_extract("part", r"(-?\d+)", 1)
    return parts.select(digits.try_cast("bigint").alias("movie_id")).filter("movie_id is not null").distinct()
