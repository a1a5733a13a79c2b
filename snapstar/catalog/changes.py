"""High-water marks, merges, landing and reruns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.catalog.base import query, register
from snapstar.catalog.shapes import FIRST_DAY, SECOND_DAY, day, films, table, write_files
from snapstar.catalog.silver import MART_SQL, SILVER_SQL, staged_rows
from snapstar.operators.incremental import newer_rows
from snapstar.operators.keyed import dimension, insert_absent, last_seen, supersede, upsert
from snapstar.plans import marts, silver
from snapstar.plans.carry import carry
from snapstar.plans.landing import land, land_files
from snapstar.plans.marts import FACT_DDL, advance_fact, merge_days
from snapstar.schemas import HISTORY_TABLES, RAW_DDL
from snapstar.session import scratch
from snapstar.sinks.write import append_days, balanced, overwrite, replace_day, replace_days
from snapstar.sources.tables import one_day, read_table

EVENTS = "select event_id, user_id, cast(ts as date) as snapshot_date from events"


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", day("ts").alias("snapshot_date"))


# --- high-water mark ---------------------------------------------------------------
@query("high_water_mark", f"select * from ({EVENTS}) e where snapshot_date > date '2024-01-15'")
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = daily_events(spark, sf_dir)
    return newer_rows(events, events.filter("snapshot_date <= date'2024-01-15'"))


@query("high_water_mark_empty", f"select * from ({EVENTS}) e where snapshot_date > date '2024-01-10'")
def high_water_mark_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty target admits days after the default one."""
    events = daily_events(spark, sf_dir)
    nothing = events.filter("snapshot_date < date'1990-01-01'")
    return newer_rows(events, nothing, default="2024-01-10")


@query("late_day_ignored", f"select * from ({EVENTS}) e where snapshot_date > date '2024-01-20'")
def late_day_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target that has one late day only: all earlier days count as late."""
    events = daily_events(spark, sf_dir)
    return newer_rows(events, one_day(events, "2024-01-20"))


# --- merges ------------------------------------------------------------------------
@query(
    "incremental_merge",
    """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderstatus <> 'P'
union all select o_orderkey, o_custkey, 'C', o_totalprice * 2 from orders where o_orderstatus = 'P'
union all select -1 - o_orderkey, o_custkey, 'N', o_totalprice from orders where o_orderstatus = 'F'
""",
)
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed orders replace theirs, new ones are added; the delta holds some keys twice."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    changed = orders.filter("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("C"))
    changed = changed.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    again = changed.withColumn("o_orderstatus", F.lit("D"))
    new = orders.filter("o_orderstatus = 'F'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    delta = changed.unionByName(again).unionByName(new.withColumn("o_orderstatus", F.lit("N")))
    return upsert(orders, delta, ["o_orderkey"])


@query(
    "write_once_landing",
    """
select l_orderkey, l_linenumber, l_partkey from lineitem
where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'F')
qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey) = 1
""",
)
def write_once_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order and number, of orders that are not there yet."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    landed = done.withColumn("l_linenumber", F.explode(F.sequence(F.lit(1), F.lit(7))))
    return insert_absent(landed, lines, ["l_orderkey", "l_linenumber"])


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("movie_id"),
        F.col("props").alias("raw_json"),
        F.concat(F.lit("events/"), "event_id").alias("source_file"),
        day("ts").alias("snapshot_date"),
        "event_type",
    )


def _landed_twice(spark: SparkSession, sf_dir: str, replace: bool) -> DataFrame:
    """Clicks first; then everything again with another text."""
    documents, path = event_documents(spark, sf_dir), scratch(spark, "landed")
    land(spark, documents.filter("event_type = 'click'").drop("event_type"), path)
    later = documents.drop("event_type").withColumn("raw_json", F.lit("{}"))
    land(spark, later, path, replace=replace)
    return read_table(spark, path, RAW_DDL)


LANDED = """
select event_id as movie_id, {text} as raw_json, 'events/' || event_id as source_file, cast(ts as date) as snapshot_date
from events
"""


@query("land_documents", LANDED.format(text="case event_type when 'click' then props else '{}' end"))
def land_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed_twice(spark, sf_dir, replace=False)


@query("overwrite_landing", LANDED.format(text="'{}'"))
def overwrite_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed_twice(spark, sf_dir, replace=True)


@query(
    "land_odd_paths",
    f"""
select case when c_custkey % 3 > 0 then c_custkey end as movie_id, '{{"id": ' || c_custkey || '}}' as raw_json,
    date '{FIRST_DAY}' as snapshot_date
from customer
""",
)
def land_odd_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose names have numbers or other ids, landed twice: nothing is lost or doubled."""
    id = F.concat(F.when(F.col("c_custkey") % 3 == 0, "x").otherwise(""), "c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit('{"id": '), "c_custkey", F.lit("}")).alias("value"),
        F.lit(f"snapshot_date={FIRST_DAY}").alias("folder"),
        F.concat(F.lit("movie_id="), id, F.lit(".json")).alias("name"),
    )
    files, path = write_files(rows, scratch(spark, "files")), scratch(spark, "landed")
    for _ in range(2):
        land_files(spark, files, path, FIRST_DAY)
    text = F.regexp_replace("raw_json", "\n$", "").alias("raw_json")
    return read_table(spark, path, RAW_DDL).select("movie_id", text, "snapshot_date")


@query(
    "land_new_files",
    f"""
select c_custkey as movie_id, '{{"id": ' || c_custkey || '}}' as raw_json, date '{FIRST_DAY}' as snapshot_date from customer
where c_custkey % 2 = 0
union all select c_custkey, '{{"new": ' || c_custkey || '}}', date '{FIRST_DAY}' from customer where c_custkey % 2 = 1
""",
)
def land_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the files first; then all are there, with new texts, and only the absent ones are landed."""
    path = scratch(spark, "landed")
    for half, field in (("c_custkey % 2 = 0", "id"), ("true", "new")):
        rows = table(spark, sf_dir, "customer").filter(half).select(
            F.concat(F.lit(f'{{"{field}": '), "c_custkey", F.lit("}")).alias("value"),
            F.lit(f"snapshot_date={FIRST_DAY}").alias("folder"),
            F.concat(F.lit("movie_id="), "c_custkey", F.lit(".json")).alias("name"),
        )
        files = write_files(rows, scratch(spark, "files") if field == "id" else files)
        land_files(spark, files, path, FIRST_DAY)
    text = F.regexp_replace("raw_json", "\n$", "").alias("raw_json")
    return read_table(spark, path, RAW_DDL).select("movie_id", text, "snapshot_date")


# --- the fact ----------------------------------------------------------------------
FACT = SILVER_SQL["fact_movie_daily_snapshot"]


def staged_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged fact as a stored table, since each of these jobs reads it more than once."""
    path = scratch(spark, "staged")
    overwrite(staged_rows(spark, sf_dir, "stg_fact_movie_daily_snapshot"), path, by="snapshot_date")
    return read_table(spark, path, FACT_DDL)


def _fact_after(spark: SparkSession, *runs: DataFrame) -> DataFrame:
    path = scratch(spark, "fact")
    for rows in runs:
        advance_fact(spark, rows, path)
    return read_table(spark, path, FACT_DDL)


@query("fct_movie_daily_snapshot", FACT)
def fct_next_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run on the first day, then a run over both days, then a rerun of it."""
    rows = staged_fact(spark, sf_dir)
    return _fact_after(spark, one_day(rows, FIRST_DAY), rows, rows)


@query("fct_late_day", f"select * from ({FACT}) f where snapshot_date = date '{SECOND_DAY}'")
def fct_late_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first day arrives after the second and stays out."""
    rows = staged_fact(spark, sf_dir)
    return _fact_after(spark, one_day(rows, SECOND_DAY), rows)


@query("fct_empty_target", f"select * from ({FACT}) f")
def fct_empty_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target without rows admits the days after the default mark."""
    rows, path = staged_fact(spark, sf_dir), scratch(spark, "fact")
    overwrite(rows.filter("movie_id is null"), path, by="snapshot_date")
    old = rows.withColumn("snapshot_date", F.date_sub("snapshot_date", 365))
    advance_fact(spark, rows.unionByName(old), path)
    return read_table(spark, path, FACT_DDL)


@query("fct_full_refresh", f"select * from ({FACT}) f where snapshot_date = date '{FIRST_DAY}'")
def fct_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = staged_fact(spark, sf_dir), scratch(spark, "fact")
    advance_fact(spark, rows, path)
    advance_fact(spark, one_day(rows, FIRST_DAY), path, full_refresh=True)
    return read_table(spark, path, FACT_DDL)


@query(
    "merge_days",
    f"""
select movie_id, snapshot_date, popularity * case when snapshot_date = date '{FIRST_DAY}' and status = 'F' then 2 else 1 end
    as popularity, vote_average, vote_count, revenue, runtime, status from ({FACT}) f
union all select -1 - movie_id, snapshot_date, popularity, vote_average, vote_count, revenue, runtime, status
from ({FACT}) f where snapshot_date = date '{FIRST_DAY}'
""",
)
def merge_late_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A late correction of the first day is merged into a table that has both."""
    rows, path = staged_fact(spark, sf_dir), scratch(spark, "fact")
    merge_days(spark, rows, path, FACT_DDL)
    first = one_day(rows, FIRST_DAY)
    doubled = first.filter("status = 'F'").withColumn("popularity", F.col("popularity") * 2)
    new = first.withColumn("movie_id", -1 - F.col("movie_id"))
    merge_days(spark, doubled.unionByName(new), path, FACT_DDL)
    return read_table(spark, path, FACT_DDL)


# --- later days on top of a finished table ----------------------------------------------
def _advanced(view: str, mart: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = staged_rows(spark, sf_dir, view)
        _, build = (marts.DIMENSIONS | marts.BRIDGES)[mart]
        return marts.ADVANCE[mart](build(one_day(staged, FIRST_DAY)), one_day(staged, SECOND_DAY))

    return run


for _mart, _view in {
    "dim_movie": "stg_movies",
    "bridge_movie_cast": "stg_movie_cast",
    "bridge_movie_crew": "stg_movie_crew",
    "bridge_movie_genre": "stg_movie_genres",
}.items():
    register(f"advance_{_mart}", _advanced(_view, _mart), MART_SQL[_mart])


def _advanced_dim(table: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        documents = films(spark, sf_dir)
        first = silver.silver_table(one_day(documents, FIRST_DAY), table)
        return silver.advance_dim(first, one_day(documents, SECOND_DAY), table)

    return run


for _table in HISTORY_TABLES:
    register(f"advance_silver_{_table}", _advanced_dim(_table), SILVER_SQL[_table])


@query("late_day_rebuild", MART_SQL["bridge_movie_crew"])
def late_day_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state of the second day only; the first day comes late and has it rebuilt."""
    staged, path = staged_rows(spark, sf_dir, "stg_movie_crew"), scratch(spark, "state")
    steps = marts.crew_bridge, marts.advance_crew_bridge
    carry(spark, path, SECOND_DAY, one_day(staged, SECOND_DAY), *steps)
    return carry(spark, path, FIRST_DAY, staged, *steps)


def _late_day_then_rerun(spark: SparkSession, rows: DataFrame, build, advance) -> DataFrame:
    """Days 9 and 10, the late day 8, a rerun of 10, then 11; equals a rebuild from all days."""
    path = scratch(spark, "state")
    days = [F.date_add(F.lit(FIRST_DAY).cast("date"), i) for i in range(4)]
    spread = F.pmod(F.xxhash64("movie_id"), F.lit(2)).cast("int")
    # The two given days become four, by film.
    rows = rows.withColumn("snapshot_date", F.date_add("snapshot_date", 2 * spread))
    stored = scratch(spark, "history")
    overwrite(rows, stored, by="snapshot_date")
    rows = read_table(spark, stored, rows.schema.toDDL())
    seen: list[int] = []
    for day_number in (1, 2, 0, 2, 3):
        seen.append(day_number)
        history = rows.filter(F.col("snapshot_date").isin([days[i] for i in seen]))
        found = carry(spark, path, f"2026-04-{8 + day_number:02d}", history, build, advance)
    return found


@query("late_day_then_rerun", MART_SQL["bridge_movie_genre"])
def late_day_then_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staged_rows(spark, sf_dir, "stg_movie_genres")
    return _late_day_then_rerun(spark, staged, marts.genre_bridge, marts.advance_genre_bridge)


@query(
    "late_day_then_rerun_dim",
    f"select genre_id, genre_name from ({SILVER_SQL['dim_genre']}) d where genre_name not like 'Line %'",
)
def late_day_then_rerun_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a silver dimension; a flag's name never changes."""
    child = silver.child_table(films(spark, sf_dir), "movie_genres").filter("genre_name not like 'Line %'")

    def build(rows: DataFrame) -> DataFrame:
        return dimension(rows, ["genre_id", "genre_name"])

    def advance(previous: DataFrame, rows: DataFrame) -> DataFrame:
        return supersede(previous, last_seen(rows, ["genre_id", "genre_name"]), ["genre_id"])

    return _late_day_then_rerun(spark, child, build, advance)


# --- reruns ----------------------------------------------------------------------------
@query("day_rerun_append", f"{EVENTS} union all {EVENTS}")
def day_rerun_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, path = daily_events(spark, sf_dir), scratch(spark, "events")
    for _ in range(2):
        append_days(balanced(events), path)
    return read_table(spark, path)


@query("day_rerun_replace", EVENTS)
def day_rerun_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, path = daily_events(spark, sf_dir), scratch(spark, "events")
    replace_days(balanced(events), path)
    replace_days(balanced(events.filter("snapshot_date > date'2024-01-10'")), path)
    return read_table(spark, path)


@query("rerun_emptied_day", f"select * from ({EVENTS}) e where snapshot_date <> date '2024-01-15'")
def rerun_emptied_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rerun of a day that has no rows any more leaves none."""
    events, path = daily_events(spark, sf_dir), scratch(spark, "events")
    replace_days(balanced(events), path)
    replace_day(events.filter("event_id is null"), path, "2024-01-15")
    return read_table(spark, path)


@query("dim_overwrite", SILVER_SQL["dim_keyword"])
def dim_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, path = silver.history_dim(films(spark, sf_dir), "dim_keyword"), scratch(spark, "dim")
    for _ in range(2):
        overwrite(dim, path)
    return read_table(spark, path)
