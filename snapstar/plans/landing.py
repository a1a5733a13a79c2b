"""Landing raw documents: one per path, which names the film and the day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapstar.functions.columns import Day, run_date
from snapstar.operators.incremental import rows_of_same_days
from snapstar.operators.keyed import insert_absent
from snapstar.plans.marts import merge_days
from snapstar.schemas import RAW_DDL
from snapstar.session import stored, workspace
from snapstar.sinks.write import DAY, append_days, balanced, replace_days
from snapstar.sources import files
from snapstar.sources.raw import file_paths, read_listed, read_raw_files
from snapstar.sources.tables import one_day, partition_values, read_or_empty, read_table

#: What makes a document: its path. The id in it may be anything, and is null in the table if it is no number.
PATH_KEYS = ["source_file", "snapshot_date"]
FILE_COLUMNS = ["movie_id", "raw_json", "source_file", "snapshot_date"]
#: Bytes of text that a file of the raw table is to have.
FILE_BYTES = 128 << 20


def absent_documents(spark: SparkSession, incoming: DataFrame, landed_path: str, day: Day = None) -> DataFrame:
    """Incoming documents whose path was not landed yet, one per path.

    Only the landed days that arrive again are looked at; when all documents are
    of one ``day``, they need not be read for that.
    """
    landed = read_or_empty(spark, landed_path, RAW_DDL)
    same_days = rows_of_same_days(landed, incoming) if day is None else one_day(landed, day)
    return insert_absent(same_days, incoming, PATH_KEYS)


def land(
    spark: SparkSession, incoming: DataFrame, landed_path: str, *, replace: bool = False, day: Day = None
) -> int:
    """Land documents; one that is there stays, or with ``replace`` is replaced. Returns how many this run landed.

    Documents of many days are shuffled once more, so that each day gets few
    files. Those of one ``day`` are written as the join left them.
    """
    if replace:
        return merge_days(spark, incoming, landed_path, RAW_DDL, PATH_KEYS, day)
    absent = absent_documents(spark, incoming, landed_path, day)
    return _add(balanced(absent) if day is None else absent, landed_path)


def absent_files(spark: SparkSession, raw_root: str, landed_path: str, day: Day) -> DataFrame:
    """The day's files that were not landed yet, (source_file, length). No file is opened for that."""
    landed = one_day(read_or_empty(spark, landed_path, RAW_DDL), day).select("source_file")
    return file_paths(spark, raw_root, day).join(_joined(landed), "source_file", "left_anti")


def _joined(paths: DataFrame) -> DataFrame:
    """Paths to join. Very many of them are not broadcast, for which the driver holds them: Spark goes by their compressed size."""
    return paths.hint("merge") if paths.count() > files.LISTED else paths


def land_files(spark: SparkSession, raw_root: str, landed_path: str, day: Day, *, replace: bool = False) -> int:
    """Land one day's files in the raw table, whose few large files replace the many small ones. Returns how many.

    A first run reads the day's folder as it is. Later, the paths that are absent
    are a table of their own, and only these files, or those in a slice with such a
    path, are opened (``read_listed``). With ``replace`` each file takes the place of its landed document,
    and documents whose file is gone stay; texts are neither ranked nor read twice.
    """
    if str(run_date(day)) not in partition_values(spark, landed_path, DAY):
        return _add(read_raw_files(spark, raw_root, day), landed_path)
    with workspace(spark):
        if replace:
            return _replace_files(spark, raw_root, landed_path, day)
        absent = stored(absent_files(spark, raw_root, landed_path, day), "absent-files")
        if absent.isEmpty():
            return 0
        new = read_listed(spark, raw_root, day, absent)
        return _add(_large(new.select(*FILE_COLUMNS), absent), landed_path)


def _replace_files(spark: SparkSession, raw_root: str, landed_path: str, day: Day) -> int:
    landed = one_day(read_table(spark, landed_path, RAW_DDL), day)
    there = _joined(file_paths(spark, raw_root, day))
    gone = stored(landed.select("source_file").join(there, "source_file", "left_anti").distinct(), "gone-files")
    seen, new = Observation(), read_raw_files(spark, raw_root, day).select(*FILE_COLUMNS)
    rows = new.observe(seen, F.count("*").alias("n"))
    if not gone.isEmpty():
        same = landed["source_file"].eqNullSafe(gone["source_file"])
        rows = rows.unionByName(landed.join(gone, same, "left_semi"))
    replace_days(rows, landed_path)
    return seen.get["n"]


def _large(rows: DataFrame, files: DataFrame) -> DataFrame:
    """The rows of small files in fewer tasks, and so larger files, without a shuffle; every core keeps some to open."""
    total = files.agg(F.sum("length")).first()[0] or 0
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // FILE_BYTES)))


def _add(rows: DataFrame, landed_path: str) -> int:
    seen = Observation()
    append_days(rows.observe(seen, F.count("*").alias("n")), landed_path)
    return seen.get["n"]
