"""One row per key, distinct rows and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.catalog.base import query
from snapstar.catalog.shapes import day, table
from snapstar.functions.columns import all_present
from snapstar.operators.keyed import dimension, latest_per_key, one_per_key
from snapstar.plans.marts import distinct_dim
from snapstar.plans.silver import most_popular


@query(
    "dedup_by_key",
    """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity) = 1
""",
)
def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return one_per_key(table(spark, sf_dir, "lineitem").select(*columns), columns[:2])


@query(
    "full_row_distinct",
    "select distinct event_type, user_id, list_value(event_type, cast(ts as date)::varchar)::varchar as tags from events",
)
def full_row_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows with an array column."""
    tags = F.array("event_type", F.date_format("ts", "yyyy-MM-dd")).alias("tags")
    rows = table(spark, sf_dir, "events").select("event_type", "user_id", tags).distinct()
    return rows.withColumn("tags", F.col("tags").cast("string"))


@query(
    "history_dim_by_key",
    """
select p_partkey, l_returnflag, l_linestatus from (
    select nullif(l_partkey, 7) as p_partkey, l_returnflag, l_linestatus, max(cast(l_shipdate as date)) as last_day
    from lineitem group by all
) g
qualify row_number() over (partition by p_partkey order by last_day desc, l_returnflag, l_linestatus) = 1
""",
)
def history_dim_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.nullif("l_partkey", F.lit(7)).alias("p_partkey"),
        "l_returnflag",
        "l_linestatus",
        day("l_shipdate").alias("snapshot_date"),
    )
    return dimension(rows, ["p_partkey", "l_returnflag", "l_linestatus"])


@query("dim_distinct", "select distinct p_brand, p_type from part where p_brand is not null")
def dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_dim(table(spark, sf_dir, "part").select("p_brand", "p_type"))


PEOPLE = """
select c_custkey % 1000 as person_id, c_name as person_name, 'customer' as known_for_department,
    nullif(c_acctbal, 0) as person_popularity from customer
union all
select s_suppkey, s_name, 'supplier', case when s_nationkey <> 3 then s_acctbal end from supplier
"""


@query(
    "person_union_rank",
    f"""
select person_id, person_name, known_for_department, person_popularity from ({PEOPLE}) p
qualify row_number() over (partition by person_id
    order by person_popularity desc nulls last, person_name nulls first, known_for_department nulls first) = 1
""",
)
def person_union_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as people in two roles."""
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey % 1000 as person_id",
        "c_name as person_name",
        "'customer' as known_for_department",
        "nullif(c_acctbal, 0) as person_popularity",
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "if(s_nationkey <> 3, s_acctbal, null) as person_popularity",
        "s_suppkey as person_id",
        "s_name as person_name",
        "'supplier' as known_for_department",
    )
    people = customers.unionByName(suppliers).selectExpr(
        "person_id",
        "person_name",
        "person_name as original_name",
        "0L as gender",
        "known_for_department",
        "cast(null as string) as profile_path",
        "person_popularity",
        "false as adult",
    )
    columns = ["person_id", "person_name", "known_for_department", "person_popularity"]
    return most_popular(people).select(*columns)


@query(
    "latest_snapshot",
    """
select user_id, event_id, event_type, value from events
qualify row_number() over (partition by user_id order by ts desc, event_id, event_type, value) = 1
""",
)
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return latest_per_key(events, ["user_id"], "ts").drop("ts")


@query(
    "latest_link",
    """
select user_id, event_type, k, event_id from (
    select user_id, event_type, cast(json_extract(props, '$.k') as bigint) as k, event_id, cast(ts as date) as d
    from events) e
where user_id is not null and event_type is not null
qualify row_number() over (partition by user_id, event_type, k order by d desc, event_id) = 1
""",
)
def latest_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["user_id", "event_type", "k"]
    links = table(spark, sf_dir, "events").select(
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        "event_id",
        day("ts").alias("snapshot_date"),
    )
    return latest_per_key(links.filter(all_present(keys[:2])), keys).drop("snapshot_date")


@query(
    "bridge_distinct",
    """
select distinct l_orderkey, l_suppkey from (select l_orderkey, nullif(l_suppkey, 5) as l_suppkey from lineitem) l
where l_orderkey is not null and l_suppkey is not null
""",
)
def bridge_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "lineitem").select("l_orderkey", F.nullif("l_suppkey", F.lit(5)).alias("l_suppkey"))
    return pairs.filter(all_present(["l_orderkey", "l_suppkey"])).distinct()
