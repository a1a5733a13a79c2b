"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Correctness never depends on these; they keep partitions even at any size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_spark(app: str = "snapstar", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, in a folder that the driver and all executors share.

    That is ``spark.checkpoint.dir``, or the warehouse where it is unset; the
    same in every mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (owned := _owned.get()) is not None:
        owned.append(path)
    return path


_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Paths that ``scratch`` gives out within are removed at the end, also after a failure.

    What is to stay must be written before, to a path from outside; a lazy result
    that reads such a path cannot be used afterwards. Workspaces nest: each removes
    its own paths. A thread started within has none.
    """
    own: list[str] = []
    token = _owned.set(own)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in own:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there, by the file system of its path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Fixed value: Spark's setting for it.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each query that runs within go as it ends.

    Else they stay until the driver collects the garbage that refers to them, so
    that a long run of writes fills the disk with them. A result that is run a
    second time makes its shuffles anew.
    """
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows, written to a fresh shared path and read again, so that their lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
