"""Upkeep of tables that grow by days: uniqueness from states, compaction, drift of documents, order of what is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapstar.catalog.base import query
from snapstar.catalog.nested import ANOMALOUS, anomalous
from snapstar.catalog.publishing import database_name
from snapstar.catalog.shapes import FIRST_DAY, day, table
from snapstar.functions.columns import day_literal
from snapstar.operators.unique import all_duplicates, check_day
from snapstar.plans.drift import drift
from snapstar.session import scratch
from snapstar.sinks.compact import compact, small_days
from snapstar.sinks.write import append_days, inspect
from snapstar.sources.discovery import released_between
from snapstar.sources.state import IDS_DDL, save_ids
from snapstar.sources.tables import one_day, read_table

EVENTS = "(select event_id, user_id, cast(ts as date) as snapshot_date from events) e"
CHECKED = ("2024-01-15", "2024-01-16", "2024-01-17")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", day("ts").alias("snapshot_date"))


# --- uniqueness ------------------------------------------------------------------------
def _checked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Three days, one after the other, and the last of them once more; what its check found, and the states."""
    events, name = _events(spark, sf_dir), database_name()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch(spark, 'states')}'")
    location = scratch(spark, "unique")
    for each in (*CHECKED, CHECKED[-1]):
        found = check_day(spark, one_day(events, each), ["user_id"], each, f"{name}.users", location=location, buckets=8)
    return found, f"{name}.users"


@query(
    "unique_day",
    f"""
select user_id, count(*) as n_rows from {EVENTS}
where snapshot_date between date '{CHECKED[0]}' and date '{CHECKED[-1]}' and user_id is not null
group by user_id having count(*) > 1 and count(*) filter (snapshot_date = date '{CHECKED[-1]}') > 0
""",
)
def unique_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir)[0]


@query(
    "unique_all_days",
    f"""
select user_id, count(*) as n_rows from {EVENTS}
where snapshot_date between date '{CHECKED[0]}' and date '{CHECKED[-1]}' and user_id is not null
group by user_id having count(*) > 1
""",
)
def unique_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_duplicates(spark, ["user_id"], _checked(spark, sf_dir)[1])


# --- compaction ------------------------------------------------------------------------
def _appended(spark: SparkSession, sf_dir: str) -> str:
    """Events by day, appended in three runs that write several files a day each."""
    path, events = scratch(spark, "appended"), _events(spark, sf_dir)
    for run in range(3):
        append_days(events.filter(F.pmod("event_id", F.lit(3)) == run).repartition(3, "event_id"), path)
    return path


@query("compact_days", f"select * from {EVENTS}")
def compact_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows are the same after the days were packed."""
    path = _appended(spark, sf_dir)
    compact(spark, path)
    return read_table(spark, path)


@query("compact_files", f"select snapshot_date, 1 as files, true as was_small from {EVENTS} group by 1")
def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each day is left, of several, and a rerun finds nothing to do."""
    path = _appended(spark, sf_dir)
    small = compact(spark, path).select("snapshot_date", (F.col("files") > 1).alias("was_small"))
    files = read_table(spark, path).select("snapshot_date", F.col("_metadata.file_path").alias("file"))
    counts = files.groupBy("snapshot_date").agg(F.count_distinct("file").cast("int").alias("files"))
    again = small_days(spark, path).select("snapshot_date")
    return counts.join(small, "snapshot_date").join(again, "snapshot_date", "left_anti")


# --- drift -----------------------------------------------------------------------------
@query(
    "drift_retyped",
    f"""
select path, 'retyped' as kind, declared, found, documents from (
    select unnest([
        {{'path': 'budget', 'declared': 'bigint', 'found': 'decimal(21,1)', 'documents': count(*) filter (event_type <> 'error' and k < 20)}},
        {{'path': 'genres', 'declared': 'array<struct<id:bigint,name:string>>', 'found': 'variant',
            'documents': count(*) filter (event_type <> 'error' and k between 20 and 39)}},
        {{'path': 'popularity', 'declared': 'double', 'found': 'string', 'documents': count(*) filter (event_type <> 'error' and k between 40 and 59)}},
        {{'path': 'id', 'declared': 'bigint', 'found': 'variant', 'documents': count(*) filter (event_type = 'error' and k >= 50)}}
    ], recursive := true) from {ANOMALOUS}) r
""",
)
def drift_retyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift(anomalous(spark, sf_dir))


@query(
    "drift_unknown",
    f"""
select 'mood' as path, 'unknown' as kind, null as declared, 'string' as found, count(*) as documents from {ANOMALOUS} where k < 50
union all select 'genres[*].tone', 'unknown', null, 'decimal(2,1)', count(*) from {ANOMALOUS} where k % 2 = 0
union all select 'credits.extra', 'unknown', null, 'struct<k:bigint>', count(*) from {ANOMALOUS} where k % 5 = 0
""",
)
def drift_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that no schema has: at the top, within the elements of an array, and in a nested object."""
    document = F.expr("""
        concat('{"id":', event_id, if(k < 50, concat(',"mood":"', event_type, '"'), ''), ',"genres":[{"id":1},{"id":2',
            if(k % 2 = 0, ',"tone":1.5', ''), '}],"credits":{', if(k % 5 = 0, concat('"extra":{"k":', k, '}'), ''), '}}')
    """)
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return drift(events.select(document.alias("raw_json")))


# --- order, defaults, a look ---------------------------------------------------------------
def _placed(rows: DataFrame, *order: str) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(Window.orderBy(*order))).drop(*order)


@query("sorted_state", "select c_custkey as movie_id, (row_number() over (order by c_custkey))::int as place from customer")
def sorted_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each id in the files of the saved state, in the order of their names."""
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("movie_id")).repartition(5)
    saved = spark.read.schema(IDS_DDL).parquet(save_ids(spark, ids, scratch(spark, "state")))
    return _placed(saved.select("movie_id", "_metadata.file_name", "_metadata.row_index"), "file_name", "row_index")


@query(
    "discovery_order",
    """
select o_orderkey as id, (row_number() over (order by cast(o_orderdate as date), o_orderkey))::int as place from orders
where cast(o_orderdate as date) between date '1996-01-01' and date '1997-12-31'
""",
)
def discovery_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each entry in the order that the listing returns them in."""
    released = F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date")
    unset = [F.lit(None).cast("boolean").alias(flag) for flag in ("adult", "video")]
    entries = table(spark, sf_dir, "orders").repartition(5).select(F.col("o_orderkey").alias("id"), released, *unset)
    listed = released_between(entries, "1996-01-01", "1997-12-31").withColumn("at", F.monotonically_increasing_id())
    return _placed(listed.select("id", "at"), "at")


@query("default_day", "select o_orderkey, true as is_today from orders")
def default_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a day, rows are of today; with one, of that day."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", day_literal().alias("given"), day_literal(FIRST_DAY).alias("other"))
    return orders.select("o_orderkey", ((F.col("given") == F.current_date()) & (F.col("other") == F.lit(FIRST_DAY).cast("date"))).alias("is_today"))


@query("inspect_rows", "select n_nationkey, n_name, n_regionkey from nation")
def inspect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A look at rows prints some of them and takes none away."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    inspect(nations)
    return nations
