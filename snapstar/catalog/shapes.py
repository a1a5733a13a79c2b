"""Film-shaped documents derived from the given tables, row by row.

Each lineitem row becomes one JSON document: its order is the film, its line
status the day, its part a cast member, its supplier a company and a crew
member. Nothing is grouped to make a document, so a hot order only means many
documents of one film, which the dedup steps have to handle.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import groupby

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from snapstar.sources.tables import NULL

DAY_OF_STATUS = "case l_linestatus when 'F' then date'2026-04-08' else date'2026-04-09' end"
FIRST_DAY, SECOND_DAY = "2026-04-08", "2026-04-09"

# Spark SQL for each field of the document of one lineitem row.
FILM = {
    "adult": "l_returnflag = 'R'",
    "backdrop_path": "concat('/b/', l_partkey)",
    "belongs_to_collection": "named_struct('id', l_suppkey, 'name', concat('Coll ', l_suppkey))",
    "budget": "l_partkey * 10",
    "genres": """
        array(
            named_struct('id', cast(ascii(l_returnflag) as bigint), 'name', l_returnflag),
            named_struct('id', nullif(l_linenumber, 1), 'name', concat('Line ', l_linenumber)),
            named_struct('id', cast(null as bigint), 'name', cast(null as string)))
    """,
    "homepage": "if(l_linenumber = 4, concat('/h/', l_partkey), null)",
    "id": "l_orderkey",
    "imdb_id": "concat('tt', l_orderkey)",
    "origin_country": "array(l_returnflag, l_linestatus, nullif(l_returnflag, 'A'))",
    "original_language": "lower(l_returnflag)",
    "original_title": "concat('Order ', l_orderkey)",
    "overview": "concat('part ', l_partkey, ' from ', l_suppkey)",
    "popularity": "l_extendedprice",
    "poster_path": "concat('/p/', l_partkey)",
    "production_companies": """
        array(named_struct(
            'id', l_suppkey, 'logo_path', concat('/l/', l_suppkey % 7), 'name', concat('Supplier ', l_suppkey),
            'origin_country', l_returnflag))
    """,
    "production_countries": """
        array(named_struct(
            'iso_3166_1', concat(l_returnflag, l_linestatus), 'name', concat('Country ', l_linenumber)))
    """,
    "release_date": """
        case l_linenumber when 1 then '' when 2 then 'x' when 3 then '2026-02-30'
            else cast(cast(l_shipdate as date) as string) end
    """,
    "revenue": "l_suppkey",
    "runtime": "l_linenumber",
    "spoken_languages": """
        array(named_struct(
            'english_name', concat('Lang ', l_returnflag), 'iso_639_1', lower(l_returnflag),
            'name', nullif(concat('L', l_linenumber), 'L1')))
    """,
    "status": "l_linestatus",
    "tagline": "nullif(l_returnflag, 'N')",
    "title": "concat('Line ', l_linenumber, ' of ', l_orderkey)",
    "video": "l_linestatus = 'F'",
    "vote_average": "l_discount",
    "vote_count": "l_partkey",
    "credits": """
        named_struct(
            'cast', array(named_struct(
                'adult', l_returnflag = 'A', 'cast_id', l_linenumber, 'character', concat('Role ', l_returnflag),
                'credit_id', concat('a', l_linenumber), 'gender', l_linenumber % 3, 'id', l_partkey,
                'known_for_department', 'Acting', 'name', concat('Part ', l_partkey), 'order', l_linenumber,
                'original_name', concat('part ', l_partkey), 'popularity', l_extendedprice,
                'profile_path', if(l_linenumber = 5, concat('/f/', l_partkey), null))),
            'crew', array(
                named_struct(
                    'adult', false, 'credit_id', concat('s', l_linenumber), 'department', 'Supply', 'gender', 0L,
                    'id', l_suppkey, 'job', concat('Job ', l_returnflag), 'known_for_department', 'Supply',
                    'name', concat('Supplier ', l_suppkey), 'original_name', concat('supplier ', l_suppkey),
                    'popularity', l_quantity, 'profile_path', concat('/s/', l_suppkey)),
                named_struct(
                    'adult', false, 'credit_id', 'w', 'department', 'Writing', 'gender', 1L,
                    'id', l_partkey, 'job', 'Writer', 'known_for_department', 'Writing',
                    'name', concat('Part ', l_partkey), 'original_name', concat('part ', l_partkey),
                    'popularity', cast(null as double), 'profile_path', cast(null as string))))
    """,
    "keywords": """
        named_struct('keywords', case when l_linenumber = 7 then array() else array(
            named_struct('id', l_partkey % 100, 'name', concat('kw ', l_linenumber))) end)
    """,
    "release_dates": """
        named_struct('results', array(named_struct(
            'iso_3166_1', l_returnflag,
            'release_dates', case l_linenumber when 1 then array() when 2 then null else array(named_struct(
                'certification', l_linestatus, 'descriptors', array(l_returnflag, l_linestatus),
                'iso_639_1', lower(l_returnflag), 'note', '',
                'release_date', concat(cast(cast(l_shipdate as date) as string), 'T00:00:00.000Z'),
                'type', l_linenumber)) end)))
    """,
    "videos": """
        named_struct('results', case when l_linenumber % 2 = 0 then array() else array(named_struct(
            'id', concat('v', l_partkey), 'iso_639_1', lower(l_returnflag), 'iso_3166_1', l_linestatus,
            'key', concat('k', l_partkey), 'name', concat('Video ', l_linenumber), 'official', l_returnflag = 'N',
            'published_at', concat(cast(cast(l_shipdate as date) as string), 'T00:00:00.000Z'), 'site', 'Site',
            'size', l_linenumber * 100, 'type', 'Trailer')) end)
    """,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str) -> Column:
    return F.col(column).cast("date")


#: Documents that a task makes at most: a row of 20 bytes in a file becomes a document of 1,700.
DEALT = 1 << 20


def dealt(rows: DataFrame, most: int | None = None) -> DataFrame:
    """The rows of a scan, dealt to even tasks in the order in which they are read, if its splits are uneven or have over ``most``.

    A split of a file is sized by its bytes. Rows that become documents are many
    times larger, so that a split of them would not fit in a task's memory where
    they are sorted; and few large row groups would leave cores idle.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    splits = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    if max(splits, default=0) <= min(most or sum(splits), 1.25 * sum(splits) / cores):
        return rows
    tasks = max(cores, -(-sum(splits) // DEALT))
    return rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(tasks, "_at").drop("_at")


def lines(spark: SparkSession, sf_dir: str, most: int | None = None) -> DataFrame:
    return line_columns(dealt(table(spark, sf_dir, "lineitem"), most))


def line_columns(lineitem: DataFrame) -> DataFrame:
    rows = lineitem.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))
    return rows.withColumn("source_file", F.concat(F.lit("snapshot/"), "l_orderkey")).withColumn(
        "snapshot_date", F.expr(DAY_OF_STATUS)
    )


def raw_films(spark: SparkSession, sf_dir: str, *, by_day: bool = False) -> DataFrame:
    """Every lineitem row as raw JSON text, in the layout of the landed table.

    With ``by_day`` the rows of a task are in the order of a write by days, sorted
    while they are narrow: a write sorts rows that are not, and then sorts the texts.
    """
    document = F.to_json(F.struct(*film_columns()))
    rows = lines(spark, sf_dir, DEALT if by_day else None)
    return (rows.sortWithinPartitions("snapshot_date") if by_day else rows).select(
        F.col("l_orderkey").alias("movie_id"), document.alias("raw_json"), "source_file", "snapshot_date"
    )


def films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents as the parsed table holds them, without the way over text."""
    return lines(spark, sf_dir, DEALT).select("source_file", "snapshot_date", *film_columns())


def film_columns() -> list[Column]:
    return [F.expr(sql).alias(field) for field, sql in FILM.items()]


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer in the columns of a line, for documents that need a file each."""
    return dealt(table(spark, sf_dir, "customer")).selectExpr(
        "c_custkey as l_orderkey",
        "c_custkey as l_partkey",
        "c_custkey as l_suppkey",
        "c_custkey % 7 + 1 as l_linenumber",
        "c_acctbal as l_extendedprice",
        "c_acctbal as l_quantity",
        "c_acctbal as l_discount",
        "substr('ANR', cast(c_custkey % 3 + 1 as int), 1) as l_returnflag",
        "if(c_nationkey < 12, 'F', 'O') as l_linestatus",
        "timestamp_ntz'2026-04-01 00:00:00' as l_shipdate",
        f"if(c_nationkey < 12, date'{FIRST_DAY}', date'{SECOND_DAY}') as snapshot_date",
    )


def write_files(rows: DataFrame, root: str) -> str:
    """Rows of (folder, name, value) as a text file each, ``root/folder/name``, the layout that crawlers leave.

    Tasks write their own files, straight to their names, so that the driver does
    nothing for a file. Rows of one name are the lines of one file; a null has the
    name of a null's folder.
    """
    whole = rows.select(*[F.coalesce(c, F.lit(NULL)).alias(c) for c in ("folder", "name")], F.coalesce("value", F.lit("")).alias("value"))
    dealt = whole.repartition("folder", "name").sortWithinPartitions("folder", "name")
    at = root if "://" in root else root.removeprefix("file:")

    def write(part: Iterable[Row]) -> None:
        files, top = fs.FileSystem.from_uri(at)
        made = set()
        for (folder, name), lines in groupby(part, lambda row: (row.folder, row.name)):
            if folder not in made:
                files.create_dir(f"{top}/{folder}")
                made.add(folder)
            with files.open_output_stream(f"{top}/{folder}/{name}", compression=None) as file:
                file.write("".join(f"{line.value}\n" for line in lines).encode())

    dealt.foreachPartition(write)
    return root
