"""Publishing, checks, and both days from landed documents to checked marts."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.catalog.base import query, register
from snapstar.catalog.shapes import FIRST_DAY, SECOND_DAY, day, films, raw_films, table
from snapstar.catalog.silver import MART_SQL, SILVER_SQL, STAGING_SQL
from snapstar.operators.quality import check_report, duplicate_keys, null_rows
from snapstar.plans.daily import build_marts, read_marts, run_after_landing, run_checks
from snapstar.plans.ledger import Ledger
from snapstar.plans.marts import create_views
from snapstar.plans.models import MODELS
from snapstar.plans.silver import daily_fact, movies, silver_table
from snapstar.schemas import HISTORY_TABLES, SILVER_TABLES, SOURCES
from snapstar.session import scratch, shuffles_removed, stored, workspace
from snapstar.sinks.publish import publish
from snapstar.sinks.write import PACKED, append, append_days, balanced, replace_days
from snapstar.sources.tables import one_day, partition_values, read_if_exists, read_table

GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents"]


def _counts(tables: dict[str, str]) -> str:
    counts = [f"select '{name}' as name, count(*) as n from ({sql}) t" for name, sql in tables.items()]
    return " union all ".join(counts)


def database_name() -> str:
    return f"snapstar_{uuid.uuid4().hex}"


@query(
    "publish_audit",
    " union all ".join(f"select '{t}' as table_name, 'loaded' as status, count(*) as num_rows from {t}" for t in GIVEN)
    + " union all select 'movies', 'loaded', count(*) from events union all select 'missing', 'failed', null",
)
def publish_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight tables, one partitioned by day, and one whose files do not exist."""
    tables = {name: table(spark, sf_dir, name) for name in GIVEN}
    tables["movies"] = table(spark, sf_dir, "events").withColumn("snapshot_date", day("ts"))
    tables["missing"] = f"{sf_dir}/no_such_table"
    audit = publish(spark, tables, database_name(), scratch(spark, "published"))
    return audit.select("table_name", "status", "num_rows")


@query(
    "publish_append",
    "select 'orders' as table_name, 'loaded' as status, 2 * count(*) as num_rows from orders",
)
def publish_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice without replacing, the table holds everything twice."""
    database, location = database_name(), scratch(spark, "published")
    for _ in range(2):
        audit = publish(spark, {"orders": table(spark, sf_dir, "orders")}, database, location, replace=False)
    return audit.select("table_name", "status", "num_rows")


# --- loads that fail, links and views -------------------------------------------------
def _after_failures(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Orders, published; then a load whose rows fail a check, one that breaks off, and one that passes its checks."""
    database, location = database_name(), scratch(spark, "published")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    checks = "orders o_orderkey not_null unique\nlines o_orderkey not_null"
    twice = orders.unionByName(orders.filter("o_custkey % 7 = 0"))
    broken = orders.withColumn("o_totalprice", F.when(F.col("o_custkey") % 7 == 0, F.raise_error(F.lit("no price")).cast("double")).otherwise(1.0))
    audits = []
    for kind, rows in (("first", orders), ("twice", twice), ("broken", broken)):
        audit = publish(spark, {"orders": rows, "lines": rows}, database, location, checks=checks)
        audits.append(audit.withColumn("load", F.lit(kind)))
    return database, reduce(DataFrame.unionByName, audits)


@query("publish_failed_check", "select o_orderkey, o_custkey, o_totalprice from orders")
def publish_failed_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neither a failing check nor a failing load takes away the rows that were there."""
    return spark.table(f"{_after_failures(spark, sf_dir)[0]}.orders")


@query(
    "publish_failed_audit",
    """
with n as (select count(*) as n, count(*) filter (o_custkey % 7 = 0) as twice from orders)
select 'first' as load, 'orders' as table_name, 'loaded' as status, n as num_rows, null as why from n
union all select 'first', 'lines', 'loaded', n, null from n
union all select 'twice', 'orders', 'failed', null, 'orders.o_orderkey unique: ' || twice from n
union all select 'twice', 'lines', 'loaded', n + twice, null from n
union all select 'broken', t, 'failed', null, 'no price' from (select unnest(['orders', 'lines']) as t) t
""",
)
def publish_failed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    why = F.when(F.col("error").contains("no price"), "no price").otherwise(F.col("error")).alias("why")
    return _after_failures(spark, sf_dir)[1].select("load", "table_name", "status", "num_rows", why)


@query(
    "publish_linked",
    """
select event_id, user_id, cast(ts as date) as snapshot_date from events
union all select -event_id, user_id, cast(ts as date) from events where cast(ts as date) = date '2024-01-15'
""",
)
def publish_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days of a table become those of the database; then one of them is written anew elsewhere, and linked again."""
    database, location, files = database_name(), scratch(spark, "published"), scratch(spark, "daily")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", day("ts").alias("snapshot_date"))
    replace_days(balanced(events), files)
    publish(spark, {"movies": files}, database, location, link=True)
    again, late = scratch(spark, "daily"), events.filter("snapshot_date = date'2024-01-15'")
    replace_days(balanced(late.unionByName(late.withColumn("event_id", -F.col("event_id")))), again)
    publish(spark, {"movies": again}, database, location, link=True, day="2024-01-15")
    return spark.table(f"{database}.movies")


FILM_TABLES = ("movies", "fact_movie_daily_snapshot")


def _staged_database(spark: SparkSession, sf_dir: str) -> str:
    """The silver tables that views read, published.

    Documents are stored, as in the parsed table, since each table reads its columns
    of them, and so are the films, which the fact has its rows from. Both go when the
    tables are published, and each shuffle with the write that needs it. Tables are
    written one after the other, so that one shuffle is on disk at a time.
    """
    database, location = database_name(), scratch(spark, "published")
    with workspace(spark), shuffles_removed(spark):
        documents = stored(films(spark, sf_dir), "documents", **PACKED)
        tables = {t: silver_table(documents, t) for t in SOURCES if t not in FILM_TABLES}
        tables["movies"] = stored(movies(documents), "films", **PACKED)
        tables["fact_movie_daily_snapshot"] = daily_fact(tables["movies"])
        publish(spark, tables, database, location, parallel=1)
    return database


@query("views_of_another_session", _counts(STAGING_SQL).replace(" as name", " as view_name"))
def views_of_another_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 11 views are in the database: a session that made none of them reads them all, also after they were replaced."""
    database = _staged_database(spark, sf_dir)
    for _ in range(2):
        create_views(spark, database)
    other, path = spark.newSession(), scratch(spark, "view-counts")
    views = [v.viewName for v in other.sql(f"SHOW VIEWS IN `{database}`").collect() if not v.isTemporary]
    counts = [other.table(f"{database}.{v}").agg(F.count("*").alias("n")).select(F.lit(v).alias("view_name"), "n") for v in views]
    reduce(DataFrame.unionByName, counts).write.parquet(path)
    return spark.read.parquet(path)


# --- models and steps -----------------------------------------------------------------
@query("marts_selected", _counts({n: MART_SQL[n] for n in ("dim_movie", "bridge_movie_genre", "dim_genre")}))
def marts_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The film dimension with what it reads, and what reads two of the views: these marts are built, and no others."""
    documents, path = films(spark, sf_dir), scratch(spark, "marts")
    tables = {t: silver_table(documents, t) for t in SOURCES}
    build_marts(spark, tables, path, choice="+dim_movie stg_movie_genres+ stg_dim_genre+")
    counts = [
        read_table(spark, f"{path}/{n}").agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n")
        for n in MODELS
        if read_if_exists(spark, f"{path}/{n}", "x int") is not None
    ]
    return reduce(DataFrame.unionByName, counts)


@query("resumed_steps", "select event_id, user_id, cast(ts as date) as snapshot_date from events")
def resumed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two steps that append; the second breaks off at first. The run that goes on repeats only that one."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", day("ts").alias("snapshot_date"))
    root = scratch(spark, "steps")
    append(events, f"{root}/given")

    def copy(source: str, target: str, fails: bool = False) -> None:
        if fails:
            raise InterruptedError
        append(read_table(spark, f"{root}/{source}"), f"{root}/{target}")

    for fails in (True, False, False):
        steps = Ledger(spark, root, FIRST_DAY, resume=True)
        try:
            steps.step("first", lambda: copy("given", "once"), f"{root}/given")
            steps.step("second", lambda: copy("once", "found", fails), f"{root}/once")  # noqa: B023
        except InterruptedError:
            continue
    return read_table(spark, f"{root}/found")


# --- checks ----------------------------------------------------------------------
@query("check_not_null", "select event_id, event_type from events where nullif(event_type, 'click') is null")
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("kind", F.expr("nullif(event_type, 'click')"))
    return null_rows(events, "kind").select("event_id", "event_type")


@query(
    "check_unique",
    "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1",
)
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_report",
    """
select 'orders' as model, 'o_orderkey' as "column", 'not_null' as test,
    count(*) filter (o_orderkey is null) as violations from orders
union all select 'orders', 'o_orderkey', 'unique', count(*) from (
    select o_orderkey from orders where o_orderkey is not null group by o_orderkey having count(*) > 1) d
union all select 'lines', 'l_suppkey', 'not_null', count(*) filter (l_suppkey = 3) from lineitem
union all select 'lines', 'l_orderkey', 'unique', count(*) from (
    select l_orderkey from lineitem where l_orderkey is not null group by l_orderkey having count(*) > 1) d
""",
)
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("l_suppkey", F.expr("nullif(l_suppkey, 3)"))
    models = {"orders": table(spark, sf_dir, "orders"), "lines": lines}
    checks = "orders o_orderkey not_null unique\nlines l_suppkey not_null\nlines l_orderkey unique"
    return check_report(models, checks)


# --- from landed documents to checked marts -----------------------------------------
# Every declared check, written out, and the rows that fail it where some do.
VIOLATIONS = f"""
select 'stg_movie_genres.genre_id not_null' as name, count(*) as n
from ({STAGING_SQL["stg_movie_genres"]}) g where genre_id is null
union all select 'first_example.id not_null', 1
union all select unnest([
    'dim_movie.movie_id not_null', 'dim_movie.movie_id unique', 'dim_genre.genre_id not_null', 'dim_genre.genre_id unique',
    'dim_person.person_id not_null', 'dim_person.person_id unique', 'fct_movie_daily_snapshot.movie_id not_null',
    'fct_movie_daily_snapshot.snapshot_date not_null', 'bridge_movie_genre.movie_id not_null',
    'bridge_movie_genre.genre_id not_null', 'bridge_movie_cast.movie_id not_null', 'bridge_movie_cast.person_id not_null',
    'dim_company.company_id not_null', 'dim_company.company_id unique', 'dim_keyword.keyword_id not_null',
    'dim_keyword.keyword_id unique', 'dim_country.country_code not_null', 'dim_country.country_code unique',
    'dim_language.language_code not_null', 'dim_language.language_code unique', 'bridge_movie_crew.movie_id not_null',
    'bridge_movie_crew.person_id not_null', 'stg_movies.movie_id not_null', 'stg_movies.snapshot_date not_null',
    'stg_fact_movie_daily_snapshot.movie_id not_null', 'stg_fact_movie_daily_snapshot.snapshot_date not_null',
    'stg_movie_genres.movie_id not_null', 'first_example.id unique', 'second_example.id not_null',
    'second_example.id unique']), 0
"""


FACT = SILVER_SQL["fact_movie_daily_snapshot"]
EXPECTED = {name: sql for name, sql in SILVER_SQL.items() if not name.startswith("dim_")} | {
    f"silver {name}": SILVER_SQL[name] for name in SILVER_SQL if name.startswith("dim_")
}


_ran: dict[tuple[str, str], tuple[str, str]] = {}


def _two_days(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Two days landed and run one after the other; returns the root and the database.

    The raw table holds several documents of a film and day here, so that every
    step has duplicates to deal with. Each day comes once and in order, so that its
    documents go when the day's tables are made of them. One run serves all queries
    of a session, as long as its tables are there.
    """
    key = spark.sparkContext.applicationId, sf_dir
    if key in _ran and spark.catalog.databaseExists(_ran[key][1]) and SECOND_DAY in partition_values(spark, f"{_ran[key][0]}/audit", "snapshot_date"):
        return _ran[key]
    root, database = _ran[key] = scratch(spark, "warehouse"), database_name()
    for run in (FIRST_DAY, SECOND_DAY):
        with shuffles_removed(spark):
            append_days(one_day(raw_films(spark, sf_dir, by_day=True), run), f"{root}/raw")
        run_after_landing(spark, root, database, run, keep=False)
    return root, database


@query(
    "two_day_run",
    f"{_counts(EXPECTED)} union all {_counts(MART_SQL)} union all {_counts({'fct_movie_daily_snapshot': FACT})} "
    f"union all {VIOLATIONS}",
)
def two_day_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of all tables after two days, and the check results."""
    root, database = _two_days(spark, sf_dir)
    tables = {f"silver {t}" if t in HISTORY_TABLES else t: spark.table(f"{database}.{t}") for t in SILVER_TABLES}
    tables |= read_marts(spark, f"{root}/marts")
    counts = [rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, rows in tables.items()]
    checks = run_checks(spark, database, f"{root}/marts").select(
        F.concat("model", F.lit("."), "column", F.lit(" "), "test").alias("name"), F.col("violations").alias("n")
    )
    return reduce(DataFrame.unionByName, counts, checks)


def _published(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.table(f"{_two_days(spark, sf_dir)[1]}.{name}")

    return run


def _modelled(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read_marts(spark, f"{_two_days(spark, sf_dir)[0]}/marts")[name]

    return run


# The rows themselves, of a table from each kind of step.
register("two_day_movie_crew", _published("movie_crew"), SILVER_SQL["movie_crew"])
register("two_day_dim_person", _published("dim_person"), SILVER_SQL["dim_person"])
register("two_day_fact", _modelled("fct_movie_daily_snapshot"), FACT)
register("two_day_dim_movie", _modelled("dim_movie"), MART_SQL["dim_movie"])
register("two_day_bridge_movie_cast", _modelled("bridge_movie_cast"), MART_SQL["bridge_movie_cast"])
