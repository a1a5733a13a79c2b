"""Parquet tables by path, and the named sources of the models."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.functions.columns import Day, day_literal
from snapstar.schemas import SOURCES
from snapstar.session import remove  # noqa: F401 (a table's folder is removed like any other)


def read_table(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    reader = spark.read.schema(ddl) if ddl else spark.read
    return reader.parquet(path)


def read_if_exists(spark: SparkSession, path: str, ddl: str) -> DataFrame | None:
    """The table, or None when it was never written.

    The schema is given, so a table that exists without rows reads as empty.
    """
    try:
        return read_table(spark, path, ddl)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    found = read_if_exists(spark, path, ddl)
    return spark.createDataFrame([], ddl) if found is None else found


#: Fixed value: the name of the folder of a null value.
NULL = "__HIVE_DEFAULT_PARTITION__"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str):
    """The files and folders that match a pattern, as the file system lists them; they stay in the JVM."""
    path, files = _folder(spark, pattern)
    return files.globStatus(path) or ()


#: Bytes and files that a task reads of a folder of small files.
TASK_BYTES, TASK_FILES = 128 << 20, 8192


def gathered(rows: DataFrame, pattern: str) -> DataFrame:
    """The rows of the files in the folders that match, in few even tasks without a shuffle; every core keeps some to open.

    Spark counts 4 MB for a file to be opened, so that small ones come 32 to a
    task, and what these tasks write comes in as many files. The folders' bytes and
    files, of which only the sums come here, say how many tasks there is work for.
    """
    spark, size, count = rows.sparkSession, 0, 0
    for found in matching(spark, pattern):
        path = found.getPath()
        total = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path)
        size, count = size + total.getLength(), count + total.getFileCount()
    return rows.coalesce(tasks_for(spark, size, count))


def tasks_for(spark: SparkSession, size: int, count: int) -> int:
    """The tasks that so many bytes of so many small files need; every core keeps some to open."""
    return max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES), -(-count // TASK_FILES))


def partition_values(spark: SparkSession, path: str, column: str, *, null: bool = False) -> list[str]:
    """The values that have a ``column=value`` folder, sorted as text, by listing one folder; no file is opened.

    ``null`` adds the name that stands for a null value, if it has a folder.
    """
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    values = [n.partition("=")[2] for n in names if n.startswith(f"{column}=")]
    return sorted(v for v in values if not v.startswith("__") or null and v == NULL)


def one_day(rows: DataFrame, day: Day = None) -> DataFrame:
    """The rows of one day; on a table partitioned by day only its files are read."""
    return rows.filter(F.col("snapshot_date") == day_literal(day))


def read_tables(spark: SparkSession, root: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    return {table: read_table(spark, f"{root}/{table}") for table in tables}


def source_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The published tables that the models may read."""
    return {name: tables[name] for name in SOURCES if name in tables}
