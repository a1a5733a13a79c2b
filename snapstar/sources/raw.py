"""Raw JSON documents as they were landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from snapstar.functions.columns import Day, day_from_path, day_literal
from snapstar.session import stored
from snapstar.sinks.write import PACKED
from snapstar.sources.files import Crowd, contents, crowd, listing
from snapstar.sources.tables import gathered, matching

FILES = "movie_id=*.json"
#: Files are dealt to so many slices by a hash of their path.
SLICES = 4096


def slice_of(path: Column | str) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(SLICES))


def read_raw_files(spark: SparkSession, root: str, day: Day = None, slices: list[int] | None = None) -> DataFrame:
    """One row per file under ``root/snapshot_date=D/movie_id=*.json``.

    Without a day, all days are read. The path gives the day and the id; an id
    that is no number is null. The scan has one root path, the day's folder or
    ``root``, and names are filtered as the folder is listed. Of other ``slices``
    than those given no file is opened: a filter on a file's path alone is applied
    to the listing. The files are dealt to few tasks (``gathered``). Very many of
    them are listed and opened by tasks (``crowd``).
    """
    folder = f"{root}/snapshot_date={day}" if day else root
    if files := crowd(spark, _days(spark, root, day), FILES, flat=True):
        paths = listing(spark, files)
        if slices is not None:
            paths = paths.filter(slice_of("source_file").isin(slices))
        return documents(contents(paths, files.tasks).select(F.col("content").alias("raw_json"), "source_file"))
    files = spark.read.option("pathGlobFilter", FILES).text(folder, wholetext=True)
    if slices is not None:
        files = files.filter(slice_of("_metadata.file_path").isin(slices))
    named = files.select(F.col("value").alias("raw_json"), F.col("_metadata.file_path").alias("source_file"))
    return documents(gathered(named, folder))


def _days(spark: SparkSession, root: str, day: Day) -> list[str]:
    """The folder of the day, or those of all days; none if there is anything else beside them."""
    if day:
        return [f"{root}/snapshot_date={day}"]
    there = matching(spark, f"{root}/*") if len(matching(spark, f"{root}/snapshot_date=*")) else ()
    days = [f.getPath() for f in there if f.isDirectory() and f.getPath().getName().startswith("snapshot_date=")]
    return [d.toString() for d in days] if len(days) == len(there) else []


def file_paths(spark: SparkSession, root: str, day: Day) -> DataFrame:
    """The day's files, (source_file, length): the name as ``read_raw_files`` gives it, and the bytes. None is opened."""
    folder = f"{root}/snapshot_date={day}"
    if files := crowd(spark, [folder], FILES, flat=True):
        return listing(spark, files).repartition(files.tasks, "source_file")
    files = spark.read.format("binaryFile").option("pathGlobFilter", FILES).load(folder)
    return gathered(files.select(F.col("_metadata.file_path").alias("source_file"), "length"), folder)


def read_listed(spark: SparkSession, root: str, day: Day, paths: DataFrame) -> DataFrame:
    """Those of a day's files that are in ``paths``, a stored part of ``file_paths``.

    Of very many files just these are opened. Of fewer, those in a slice with such a
    path, and the numbers of these slices come to the driver.
    """
    if files := crowd(spark, [f"{root}/snapshot_date={day}"], FILES, flat=True):
        return documents(contents(paths, files.tasks).select(F.col("content").alias("raw_json"), "source_file"))
    slices = [r[0] for r in paths.select(slice_of("source_file")).distinct().collect()]
    return read_raw_files(spark, root, day, slices).join(paths, "source_file", "left_semi")


def documents(files: DataFrame) -> DataFrame:
    """Day and id beside the text and path of each file."""
    path = F.col("source_file")
    return (
        files
        .withColumn("snapshot_date", day_from_path(path))
        .withColumn("movie_id", F.regexp_extract(path, r"movie_id=(\d+)", 1).try_cast("bigint"))
    )


def named_files(spark: SparkSession, path: str, ddl: str | None = None, *, once: bool = False) -> DataFrame:
    """JSON files of one document each; the last part of ``path`` may be a pattern of names, what is before it one of folders.

    Only folders are root paths of the scan: as a root path each file would be
    listed on its own. What the listing finds further below is left out. Where
    nothing matches, Spark raises that the path is not there. The schema, if none is
    given, is inferred from the texts: from files Spark looks up one after the other.
    With ``once`` these texts are stored (``scratch``) and the documents come from
    them, so that no file is opened a second time. Very many files are listed and
    opened by tasks (``crowd``); documents of a given schema then have their file's
    path in a column ``_metadata.file_path``, where a scan has it hidden.
    """
    folder, _, name = path.rpartition("/")
    reader = spark.read.option("multiLine", True)
    once = once and ddl is None
    if set("*?") & set(name):
        folders = [f.getPath().toString() for f in matching(spark, folder) if f.isDirectory()]
        if files := crowd(spark, folders, name):
            return _crowd_documents(spark, files, ddl, once)
    if not set("*?[{") & set(name) or not once and not matching(spark, path):
        return (reader.schema(ddl) if ddl else reader).json(path)
    folders = [f.getPath().toUri().getRawPath() for f in matching(spark, folder) if f.isDirectory()]
    own = F.regexp_extract("_metadata.file_path", "^(?:[^:/]+:)?(?://[^/]*)?(.*)/", 1).isin(folders)
    below = {"pathGlobFilter": name, "recursiveFileLookup": "true"}
    if ddl is None:
        texts = gathered(spark.read.options(**below).text(folder, wholetext=True).filter(own).select("value"), folder)
        texts = stored(texts, "texts", **PACKED) if once else texts
        if once and texts.isEmpty():
            return reader.json(path)
        lines = texts.rdd.map(lambda row: row[0])
        schema = spark.read.json(lines).schema
        if once:
            return spark.read.schema(schema).json(lines)
    else:
        schema = ddl
    return gathered(reader.schema(schema).options(**below).json(folder).filter(own), folder)


def _crowd_documents(spark: SparkSession, files: Crowd, ddl: str | None, once: bool) -> DataFrame:
    texts = contents(listing(spark, files), files.tasks, text=True)
    if ddl is None:
        texts = texts.select(F.col("content").alias("value"))
        texts = stored(texts, "texts", **PACKED) if once else texts
        lines = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
        read = lambda reader: spark.read._df(reader._jreader.json(lines))
        return read(spark.read.schema(read(spark.read).schema))
    # As a scan reads them: an array is a row for each element, and what is no JSON a row of nulls.
    document = StructType.fromDDL(ddl)
    one, many = F.from_json("content", document), F.from_json("content", ArrayType(document))
    unread = F.array(F.lit(None).cast(document))
    rows = F.when(~F.is_valid_utf8("content"), unread).when(F.col("content").rlike(r"^\s*\["), F.coalesce(many, unread)).otherwise(F.array(one))
    found = texts.filter(F.col("content").rlike(r"\S"))
    return found.select(F.inline(rows), F.struct(F.col("source_file").alias("file_path")).alias("_metadata"))


def read_inferred(spark: SparkSession, path: str, day: Day = None, *, once: bool = False) -> DataFrame:
    """Pretty-printed documents, one per file, with the schema they show; ``once`` as in ``named_files``."""
    return named_files(spark, path, once=once).withColumn("snapshot_date", day_literal(day))
