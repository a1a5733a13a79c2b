"""Discovery and the universe of tracked ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapstar.catalog.base import query
from snapstar.catalog.shapes import FIRST_DAY, SECOND_DAY, customer_lines, day, table, write_files
from snapstar.functions.columns import lookback
from snapstar.operators.keyed import set_difference
from snapstar.plans.universe import backfill, new_ids, run_metrics, track, update_universe, updated_universe
from snapstar.session import scratch, stored
from snapstar.sources.discovery import discovered_ids, listed, missing_pages, read_pages, released_between
from snapstar.sources.state import add_ids, known_ids, load_ids, read_id_array, save_ids


def write_pages(spark: SparkSession, sf_dir: str, window: str | None = None, lost: int = 0) -> str:
    """A page of two entries per customer; every fourth film came out in January, the second entry is for adults."""
    page = F.expr("""
        to_json(named_struct(
            'page', page, 'total_pages', total_pages, 'results', array(
                named_struct('id', l_orderkey, 'adult', false, 'video', false, 'release_date',
                    if(l_orderkey % 4 = 0, '2026-01-01', date_format(snapshot_date, 'yyyy-MM-dd'))),
                named_struct('id', l_orderkey + 1000000, 'adult', true, 'video', false, 'release_date',
                    date_format(snapshot_date, 'yyyy-MM-dd')))), map('pretty', 'true')) as value
    """)
    folder = F.concat(F.lit("snapshot_date="), F.col("snapshot_date").cast("string"))
    if window:
        folder = F.lit(f"snapshot_date={SECOND_DAY}/window={window}")
    rows = customer_lines(spark, sf_dir).withColumn("folder", folder)
    own = Window.partitionBy("folder")
    numbered = rows.withColumn("page", F.row_number().over(own.orderBy("l_orderkey")))
    numbered = numbered.withColumn("total_pages", F.count("*").over(own)).filter(f"page <> {lost}")
    name = F.concat(F.lit("page="), "page", F.lit(".json")).alias("name")
    return write_files(numbered.select("folder", name, page), scratch(spark, "pages"))


DAYS = f"""
(select c_custkey, c_custkey % 4 = 0 as old,
    case when c_nationkey < 12 then date '{FIRST_DAY}' else date '{SECOND_DAY}' end as d from customer) s
"""


@query(
    "paged_discovery",
    "select distinct c_custkey as movie_id from customer union select c_custkey + 1000000 from customer",
)
def paged_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovered_ids(listed(read_pages(spark, write_pages(spark, sf_dir))))


@query(
    "missing_page",
    f"""
select 'snapshot_date=' || d as folder, count(*) - 1 as landed, count(*) as total_pages
from (select case when c_nationkey < 12 then date '{FIRST_DAY}' else date '{SECOND_DAY}' end as d from customer) s group by d
""",
)
def missing_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings whose second page was lost."""
    pages = missing_pages(read_pages(spark, write_pages(spark, sf_dir, lost=2)))
    return pages.withColumn("folder", F.regexp_extract("folder", "([^/]+)$", 1))


@query(
    "discovery_window",
    """
select o_orderkey as id, strftime(o_orderdate, '%Y-%m-%d') as release_date from orders
where cast(o_orderdate as date) between date '1996-01-01' and date '1997-12-31'
    and o_orderpriority <> '1-URGENT' and o_orderstatus <> 'P'
""",
)
def discovery_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"),
        (F.col("o_orderpriority") == "1-URGENT").alias("adult"),
        F.when(F.col("o_orderstatus") == "P", F.lit(True)).alias("video"),
    )
    return released_between(entries, "1996-01-01", "1997-12-31").select("id", "release_date")


@query(
    "lookback_window",
    """
select event_id, cast(ts as date) as snapshot_date from events
where cast(ts as date) between date '2024-01-19' and date '2024-01-20'
""",
)
def lookback_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", day("ts").alias("snapshot_date"))
    return events.filter(lookback(F.col("snapshot_date"), "2024-01-20", 1))


def _ids(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.col(column).alias("movie_id"))


def ordering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(table(spark, sf_dir, "orders"), "o_custkey")


def open_ordering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(table(spark, sf_dir, "orders").filter("o_orderstatus = 'O' and o_totalprice < 200000"), "o_custkey")


TRACKED = "select distinct o_custkey as movie_id from orders where o_orderstatus = 'O' and o_totalprice < 200000"


@query("new_ids", f"select o_custkey as movie_id from orders except ({TRACKED})")
def truly_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_ids(ordering(spark, sf_dir), open_ordering(spark, sf_dir))


@query("universe_update", "select c_custkey as movie_id from customer union select s_suppkey + 1000 from supplier")
def universe_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved state read, extended and saved again."""
    path = scratch(spark, "state")
    save_ids(spark, _ids(table(spark, sf_dir, "customer"), "c_custkey"), path)
    suppliers = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1000).alias("movie_id"))
    save_ids(spark, updated_universe(load_ids(spark, path), suppliers), path)
    return load_ids(spark, path)


@query(
    "universe_log",
    """
select c_custkey as movie_id from customer union select s_suppkey + 1000 from supplier union select o_custkey from orders
""",
)
def universe_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the base; then runs that add the suppliers and, order month by month, what these bring."""
    path = scratch(spark, "state")
    orders = table(spark, sf_dir, "orders").selectExpr("o_custkey as movie_id", "month(o_orderdate) as run")
    suppliers = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1000).alias("movie_id"))
    save_ids(spark, _ids(table(spark, sf_dir, "customer").filter("c_custkey % 3 > 0"), "c_custkey"), path)
    for ids in (suppliers, *(orders.filter(f"run = {m}").select("movie_id") for m in (1, 2, 3)), orders.select("movie_id")):
        found = stored(ids.distinct(), "found")
        add_ids(spark, set_difference(found, known_ids(load_ids(spark, path), found)), path)
    rest = stored(_ids(table(spark, sf_dir, "customer"), "c_custkey"), "found")
    track(spark, path, rest, rest)
    return load_ids(spark, path)


LOG_METRICS = """
with tracked as (select o_custkey as movie_id from orders group by 1), found as (select c_custkey as movie_id from customer),
landed as (select s_suppkey as movie_id from supplier),
universe as (select movie_id from tracked union select movie_id from found)
select (select count(*) from tracked) as existing, (select count(*) from found) as discovered,
    (select count(*) from (select * from found except select * from tracked) x) as truly_new,
    (select count(*) from (select * from universe intersect select * from landed) x) as succeeded,
    (select count(*) from (select * from universe except select * from landed) x) as failed,
    (select count(*) from universe) as universe_size
"""


@query("universe_log_metrics", LOG_METRICS)
def universe_log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "state")
    save_ids(spark, ordering(spark, sf_dir), path)
    return track(spark, path, _ids(table(spark, sf_dir, "customer"), "c_custkey"), _ids(table(spark, sf_dir, "supplier"), "s_suppkey"))


@query("universe_first_load", "select distinct s_nationkey::bigint as movie_id from supplier")
def universe_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a saved state the universe starts empty."""
    nothing = load_ids(spark, scratch(spark, "state"))
    found = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("bigint").alias("movie_id"))
    return updated_universe(nothing, found)


@query("id_array_state", "select c_custkey as movie_id from customer")
def id_array_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state kept as a JSON array with one id per line."""
    path = scratch(spark, "array")
    customers = table(spark, sf_dir, "customer")
    customers.select(F.concat(F.lit("  "), "c_custkey", F.lit(",")).alias("value")).write.text(path)
    return read_id_array(spark, path)


@query(
    "run_metrics",
    f"""
with tracked as ({TRACKED}), found as (select distinct c_custkey as movie_id from customer where c_nationkey < 9),
landed as (select distinct o_custkey as movie_id from orders where o_orderstatus = 'F'),
universe as (select movie_id from tracked union select movie_id from found)
select (select count(*) from tracked) as existing, (select count(*) from found) as discovered,
    (select count(*) from (select movie_id from found except select movie_id from tracked) x) as truly_new,
    (select count(*) from (select movie_id from universe intersect select movie_id from landed) x) as succeeded,
    (select count(*) from (select movie_id from universe except select movie_id from landed) x) as failed,
    (select count(*) from universe) as universe_size
""",
)
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _ids(table(spark, sf_dir, "customer").filter("c_nationkey < 9"), "c_custkey")
    landed = _ids(table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'"), "o_custkey")
    return run_metrics(open_ordering(spark, sf_dir), found, landed)


METRICS = """
select count(*) filter (tracked) as existing, count(*) filter (found) as discovered,
    count(*) filter (found and not tracked) as truly_new, cast(0 as bigint) as succeeded,
    count(*) as failed, count(*) as universe_size
from (
    select movie_id, bool_or(tracked) as tracked, bool_or(found) as found from (
        select n_nationkey::bigint as movie_id, true as tracked, false as found from nation
        union all select c_custkey, false, true from {days} where not old and {which}
    ) u group by movie_id
) ids
"""


def _tracking_nations(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark, "state")
    save_ids(spark, table(spark, sf_dir, "nation").selectExpr("cast(n_nationkey as bigint) as movie_id"), path)
    return path


@query("update_universe", METRICS.format(days=DAYS, which=f"d = date '{FIRST_DAY}'"))
def daily_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The films released on the day itself join the universe."""
    return update_universe(spark, write_pages(spark, sf_dir), _tracking_nations(spark, sf_dir), FIRST_DAY)


@query("backfill_universe", METRICS.format(days=DAYS, which="true"))
def backfill_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both days at once, from pages landed for that range."""
    pages = write_pages(spark, sf_dir, f"{FIRST_DAY}_{SECOND_DAY}")
    return backfill(spark, pages, _tracking_nations(spark, sf_dir), FIRST_DAY, SECOND_DAY, SECOND_DAY)
