"""Packing the many small files of appended days into few full ones."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapstar.sinks.write import DAY, at_once, replace_days
from snapstar.sources.tables import read_table

#: Bytes of a full file.
FULL = 128 << 20
AUDIT_DDL = "snapshot_date date, files bigint, bytes bigint, wanted bigint"


def small_days(spark: SparkSession, path: str, full: int = FULL) -> DataFrame:
    """(snapshot_date, files, bytes, wanted): the days that have more files than their bytes need; found by listing, none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    day = F.try_to_date(F.regexp_extract("path", f"{DAY}=([^/]+)/", 1)).alias(DAY)
    sizes = files.select(day, "length").groupBy(DAY).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    wanted = F.greatest(F.ceil(F.col("bytes") / full), F.lit(1)).cast("long")
    return sizes.withColumn("wanted", wanted).filter(f"files > wanted and {DAY} is not null")


def compact(spark: SparkSession, path: str, ddl: str | None = None, *, full: int = FULL, parallel: int = 4) -> DataFrame:
    """Pack each day of a table partitioned by day that has too many files; returns the plan that it followed.

    Rows stay as they are, without a shuffle: a task reads the files that become
    one. Each day is written aside and swapped on its own, so that a run that breaks
    off leaves every day whole; run again, it finds nothing to do. A row for each
    such day comes to the driver.
    """
    plan = small_days(spark, path, full).orderBy(DAY).collect()
    schema = read_table(spark, path, ddl).schema
    own = StructType([f for f in schema if f.name != DAY])

    def pack(day, wanted: int) -> None:
        # Only the day's folder is listed: others may be swapped meanwhile.
        rows = spark.read.schema(own).parquet(f"{path}/{DAY}={day}").withColumn(DAY, F.lit(day))
        replace_days(rows.select(*schema.names).coalesce(wanted), path)

    at_once([partial(pack, r[DAY], r["wanted"]) for r in plan], parallel)
    return spark.createDataFrame([tuple(r) for r in plan], AUDIT_DDL)
