"""Uniqueness of a table that grows by days, checked against the keys of earlier days, not against their rows.

The state of a day has each of its keys once, with the number of rows. States are
one table, partitioned by day and bucketed and sorted by key, so that a day's
keys are brought to the buckets and the states stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.functions.columns import Day, all_present, run_date
from snapstar.session import stored, workspace
from snapstar.sinks.write import DAY

#: Buckets of the states; set by the keys that are expected, some ten million in each bucket and day.
BUCKETS = 64


def day_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_rows): the keys that rows have, nulls left out; combined before the shuffle."""
    return rows.filter(all_present(keys)).groupBy(*keys).agg(F.count("*").alias("n_rows"))


def check_day(
    spark: SparkSession, rows: DataFrame, keys: list[str], day: Day, state: str, *, location: str, buckets: int = BUCKETS
) -> DataFrame:
    """(keys, n_rows): the keys of a day's rows that the table has more than once, with all their rows up to now.

    The day's rows are read, and the states of other days in the table ``state``,
    which is made by the first check. The day's state is put in place of one that is
    there, so that a rerun counts nothing twice. What is returned is stored.
    """
    with workspace(spark):
        own = stored(day_keys(rows, keys), "day-keys")
        total = own
        if spark.catalog.tableExists(state):
            others = spark.table(state).filter(F.col(DAY) != F.lit(run_date(day)).cast("date"))
            total = own.unionByName(others.join(own.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.sum("n_rows").alias("n_rows")))
        found = total.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows")).filter("n_rows > 1")
        failed = f"{location}/failed/{DAY}={run_date(day)}"
        found.write.mode("overwrite").parquet(failed)
        _keep(spark, own, keys, day, state, f"{location}/keys", buckets)
    return spark.read.schema(found.schema).parquet(failed)


def _keep(spark: SparkSession, own: DataFrame, keys: list[str], day: Day, state: str, location: str, buckets: int) -> None:
    if not spark.catalog.tableExists(state):
        empty = own.limit(0).withColumn(DAY, F.lit(None).cast("date"))
        empty.write.partitionBy(DAY).bucketBy(buckets, *keys).sortBy(*keys).option("path", location).saveAsTable(state)
    columns = ", ".join(f"`{c}`" for c in own.columns)
    # One task a bucket, so that a bucket of a day is one file.
    spark.sql(
        f"INSERT OVERWRITE TABLE {state} PARTITION ({DAY} = DATE'{run_date(day)}') SELECT {columns} FROM {{own}}",
        own=own.repartition(buckets, *keys),
    )


def all_duplicates(spark: SparkSession, keys: list[str], state: str) -> DataFrame:
    """(keys, n_rows): the keys that all days together have more than once, added up bucket by bucket, without an exchange."""
    return spark.table(state).groupBy(*keys).agg(F.sum("n_rows").alias("n_rows")).filter("n_rows > 1")
