"""Scans, parsing and unnesting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.catalog.base import query, register
from snapstar.catalog.shapes import FIRST_DAY, customer_lines, day, film_columns, raw_films, table, write_files
from snapstar.catalog.silver import CAST, DOC
from snapstar.functions.columns import any_present, day_from_path, day_literal, parse_json, safe_date
from snapstar.operators.explode import explode_child
from snapstar.plans.examples import flatten_documents, flatten_file
from snapstar.plans.marts import cast_bridge, staging_view
from snapstar.plans.parse import parse_documents, parse_raw, readable, rejected, some_fields
from snapstar.schemas import CHILDREN, PARSED_DDL, Child, Level
from snapstar.session import scratch
from snapstar.sinks.write import append_days, balanced
from snapstar.sources.raw import read_inferred, read_raw_files
from snapstar.sources.tables import one_day, read_table


@query(
    "latest_credits",
    f"""
select movie_id, person_id, character, cast_order, credit_id from ({CAST}) c
qualify row_number() over (partition by movie_id, person_id, credit_id
    order by snapshot_date desc, character nulls first, cast_order nulls first) = 1
""",
)
def latest_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge straight from JSON: two fields are parsed, and the rank alone removes copies."""
    documents = readable(parse_documents(raw_films(spark, sf_dir), some_fields("id", "credits.cast")))
    return cast_bridge(explode_child(documents, CHILDREN["movie_cast"]))


# --- parsing -------------------------------------------------------------------
@query("parse_json_text", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def parse_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "events").select("event_id", parse_json(F.col("props"), "k bigint").alias("parsed"))
    return parsed.select("event_id", "parsed.*").filter("k is not null")


def anomalous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a document, with one of seven anomalies by its type and value."""
    k = "get_json_object(props, '$.k')"
    text = f"""
        case
            when event_type = 'error' and cast({k} as int) < 50 then '{{bad json'
            when event_type = 'error' then '{{"id":"notnum","budget":7}}'
            when cast({k} as int) < 20 then concat('{{"id":', event_id, ',"budget":1.5,"title":"half"}}')
            when cast({k} as int) < 40 then concat('{{"id":', event_id, ',"genres":{{"id":3}},"budget":', {k}, '}}')
            when cast({k} as int) < 60 then concat('{{"id":', event_id, ',"popularity":"abc","budget":', {k}, '}} tail')
            when cast({k} as int) < 70 then concat('[{{"id":', event_id, '}}]')
            else concat('{{"id":', event_id, ',\\n "genres":[{{"id":1,"name":"A"}},null],',
                '"belongs_to_collection":{{"id":9,"name":"C"}},"budget":', {k}, '}}')
        end
    """
    return table(spark, sf_dir, "events").select(
        F.expr(text).alias("raw_json"),
        F.concat(F.lit("/raw/event_id="), "event_id", F.lit(".json")).alias("source_file"),
        day("ts").alias("snapshot_date"),
    )


ANOMALOUS = """
(select event_id, event_type, cast(ts as date) as snapshot_date,
    cast(json_extract(props, '$.k') as bigint) as k from events) e
"""


@query(
    "parse_malformed",
    f"""
select event_id as id, snapshot_date, case when k >= 20 then k end as budget,
    case when k < 20 then 'half' end as title, cast(case when k >= 70 then 2 end as bigint) as n_genres,
    case when k >= 70 then '{{"id":9,"name":"C"}}' end as belongs_to_collection
from {ANOMALOUS} where event_type <> 'error' and not (k >= 60 and k < 70)
""",
)
def parse_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = readable(parse_documents(anomalous(spark, sf_dir)))
    sized = F.when(F.col("genres").isNotNull(), F.size("genres")).cast("bigint").alias("n_genres")
    return good.select("id", "snapshot_date", "budget", "title", sized, "belongs_to_collection")


@query(
    "rejected_documents",
    f"""
select '/raw/event_id=' || event_id || '.json' as source_file, snapshot_date
from {ANOMALOUS} where event_type = 'error' or (k >= 60 and k < 70)
""",
)
def rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(parse_documents(anomalous(spark, sf_dir))).drop("raw_json")


@query(
    "parse_documents",
    f"""
select movie_id as id, snapshot_date, 'snapshot/' || movie_id as source_file, 'Line ' || n || ' of ' || movie_id as title,
    f = 'R' as adult, price as popularity, p * 10 as budget, '{{"id":' || s || ',"name":"Coll ' || s || '"}}'
    as belongs_to_collection, cast(3 as bigint) as n_genres, p as lead_id, case when n > 2 then t end as certification
from {DOC}
""",
)
def parse_whole_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = readable(parse_documents(raw_films(spark, sf_dir)))
    return documents.select(
        "id",
        "snapshot_date",
        "source_file",
        "title",
        "adult",
        "popularity",
        "budget",
        "belongs_to_collection",
        F.size("genres").cast("bigint").alias("n_genres"),
        F.get("credits.cast", F.lit(0))["id"].alias("lead_id"),
        F.get(F.get("release_dates.results", F.lit(0))["release_dates"], F.lit(0))["certification"].alias(
            "certification"
        ),
    )


@query(
    "path_day",
    """
select event_id, case when event_type <> 'view' then cast(ts as date) end as snapshot_date from events
""",
)
def path_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = F.concat(F.lit("s3a://bucket/raw/snapshot_date="), day("ts").cast("string"), F.lit("/movie_id=1.json"))
    path = F.when(F.col("event_type") != "view", stated).otherwise(F.lit("s3a://bucket/raw/movie_id=1.json"))
    return table(spark, sf_dir, "events").select("event_id", day_from_path(path).alias("snapshot_date"))


@query(
    "safe_date_cast",
    """
select o_orderkey, case o_orderpriority when '1-URGENT' then null when '2-HIGH' then null
    when '5-LOW' then null else cast(o_orderdate as date) end as released
from orders
""",
)
def safe_date_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("""
        case o_orderpriority when '1-URGENT' then '' when '2-HIGH' then '2026-02-30' when '5-LOW' then 'x'
            else date_format(o_orderdate, 'yyyy-MM-dd') end
    """)
    return table(spark, sf_dir, "orders").select("o_orderkey", safe_date(text).alias("released"))


@query(
    "root_projection",
    """
select o_orderkey as movie_id, cast(o_orderdate as date) as snapshot_date, o_totalprice as popularity,
    o_orderstatus as status from orders
""",
)
def root_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("movie_id"),
        day("o_orderdate").alias("snapshot_date"),
        F.col("o_totalprice").alias("popularity"),
        F.col("o_orderstatus").alias("status"),
    )


@query(
    "staging_typed_view",
    """
select cast(l_orderkey as bigint) as movie_id, cast(l_shipdate as date) as snapshot_date,
    cast(l_quantity as double) as quantity, l_returnflag = 'R' as returned, l_linestatus as status
from lineitem where nullif(l_linenumber, 7) is not null
""",
)
def staging_typed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict casts from text, of rows that have their key."""
    text = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("movie_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("snapshot_date"),
        F.col("l_quantity").cast("string").alias("quantity"),
        (F.col("l_returnflag") == "R").cast("string").alias("returned"),
        F.col("l_linestatus").alias("status"),
        F.nullif("l_linenumber", F.lit(7)).alias("line"),
    )
    return staging_view(
        text, "movie_id bigint, snapshot_date date, quantity double, returned boolean, status", required="line"
    )


@query("any_identifier_filter", "select event_id, k, kind from (" + """
select event_id, nullif(cast(json_extract(props, '$.k') as bigint), 7) as k, nullif(event_type, 'click') as kind
from events) e where k is not null or kind is not null""")
def any_identifier_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.expr("nullif(cast(get_json_object(props, '$.k') as bigint), 7) as k"),
        F.expr("nullif(event_type, 'click') as kind"),
    )
    return rows.filter(any_present(["k", "kind"]))


# --- unnesting -------------------------------------------------------------------
PARTIES = Child((Level("parties", "id as party_id, role, line as line_number"),), "party_id")


@query(
    "child_explode",
    """
select distinct * from (
    select l_orderkey as movie_id, cast(l_shipdate as date) as snapshot_date, l_partkey as party_id, 'part' as role,
        l_linenumber as line_number from lineitem
    union all
    select l_orderkey, cast(l_shipdate as date), nullif(l_suppkey, 1), 'supplier', l_linenumber from lineitem
) r where party_id is not null
""",
)
def child_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    parties = F.expr("""
        array(named_struct('id', l_partkey, 'role', 'part', 'line', l_linenumber), null,
            named_struct('id', nullif(l_suppkey, 1), 'role', 'supplier', 'line', l_linenumber)) as parties
    """)
    documents = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), day("l_shipdate").alias("snapshot_date"), parties
    )
    return explode_child(documents, PARTIES).distinct()


@query(
    "scalar_array_explode",
    """
select distinct doc_id, unnest(string_split(text, ' ')) as word from documents
""",
)
def scalar_array_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct words of every whole text."""
    words = Child((Level("words", "* as word"),), "word")
    documents = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return explode_child(documents, words, [F.col("doc_id")]).distinct()


@query(
    "two_level_outer",
    """
with lines as (
    select doc_id, unnest(string_split(text, chr(10))) as text,
        unnest(range(len(string_split(text, chr(10))))) as line
    from documents
)
select distinct doc_id, cast(lines.line as int) as line, w.word
from lines left join lateral (
    select u.word from (select unnest(string_split(lines.text, ' ')) as word) u where length(u.word) >= 14
) w on true
""",
)
def two_level_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and their long words; a line without any stays, with a null word."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda text, i: F.struct(
            i.alias("line"), F.filter(F.split(text, " "), lambda w: F.length(w) >= 14).alias("words")
        ),
    )
    nested = Child((Level("lines", "line"), Level("words", "* as word", keep_empty=True)), "line, word")
    documents = table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines"))
    return explode_child(documents, nested, [F.col("doc_id")]).distinct()


# --- files ---------------------------------------------------------------------
def write_customer_files(spark: SparkSession, sf_dir: str) -> str:
    """Every customer as one pretty-printed document in a file of its own."""
    document = F.to_json(F.struct(*film_columns()), {"pretty": "true"})
    rows = customer_lines(spark, sf_dir).select(
        document.alias("value"),
        F.concat(F.lit("snapshot_date="), F.col("snapshot_date").cast("string")).alias("folder"),
        F.concat(F.lit("movie_id="), "l_orderkey", F.lit(".json")).alias("name"),
    )
    return write_files(rows, scratch(spark, "files"))


CUSTOMER_DOC = """
(select c_custkey as movie_id, c_custkey % 7 + 1 as n, c_custkey % 3 as r,
    case when c_nationkey < 12 then date '2026-04-08' else date '2026-04-09' end as snapshot_date from customer) doc
"""


@query(
    "wholetext_scan",
    f"""
select movie_id, snapshot_date, 'Line ' || n || ' of ' || movie_id as title,
    'snapshot_date=' || snapshot_date || '/movie_id=' || movie_id || '.json' as file
from {CUSTOMER_DOC}
""",
)
def wholetext_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = read_raw_files(spark, write_customer_files(spark, sf_dir))
    title = F.get_json_object("raw_json", "$.title").alias("title")
    file = F.regexp_extract("source_file", r"(snapshot_date=[^/]+/movie_id=[^/]+)", 1).alias("file")
    return files.select("movie_id", "snapshot_date", title, file)


@query(
    "parse_day_files",
    f"select movie_id as id, snapshot_date, n as runtime from {CUSTOMER_DOC} where snapshot_date = date '{FIRST_DAY}'",
)
def parse_day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's files into the parsed table, twice: replacing a day makes the rerun safe."""
    files, parsed = write_customer_files(spark, sf_dir), scratch(spark, "parsed")
    for _ in range(2):
        parse_raw(spark, files, parsed, FIRST_DAY, mode="replace_day")
    return read_table(spark, parsed, PARSED_DDL).select("id", "snapshot_date", "runtime")


@query(
    "multiline_json_scan",
    f"""
select movie_id, date '2026-04-05' as snapshot_date, genre_id, genre_name from (
    select movie_id, ascii(substr('ANR', cast(r as int) + 1, 1)) as genre_id, substr('ANR', cast(r as int) + 1, 1) as genre_name
    from {CUSTOMER_DOC}
    union all select movie_id, nullif(n, 1), 'Line ' || n from {CUSTOMER_DOC}
    union all select movie_id, null, null from {CUSTOMER_DOC}
) g
""",
)
def multiline_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_customer_files(spark, sf_dir) + "/snapshot_date=*/movie_id=*.json"
    return flatten_documents(read_inferred(spark, path, "2026-04-05"))["movie_genres"]


def _prototype_table(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, out = write_customer_files(spark, sf_dir) + "/snapshot_date=*/movie_id=*.json", scratch(spark, "flat")
        flatten_file(spark, path, out, "2026-04-05")
        rows = read_table(spark, f"{out}/{name}")
        return rows.withColumn("descriptors", F.array_join("descriptors", ",")) if "descriptors" in rows.columns else rows

    return run


# The unfiltered tables appended under a root: every row of the film, of an array of each depth, and of plain strings.
PROTOTYPES = {
    "movies": f"""
select movie_id, 'Line ' || n || ' of ' || movie_id as title, 'Order ' || movie_id as original_title,
    lower(f) as original_language, 'part ' || movie_id || ' from ' || movie_id as overview,
    case when n = 4 then '/h/' || movie_id end as homepage, 'tt' || movie_id as imdb_id,
    case n when 1 then '' when 2 then 'x' when 3 then '2026-02-30' else '2026-04-01' end as release_date,
    n as runtime, case when snapshot_date = date '{FIRST_DAY}' then 'F' else 'O' end as status,
    nullif(f, 'N') as tagline, f = 'R' as adult, snapshot_date = date '{FIRST_DAY}' as video,
    movie_id * 10 as budget, movie_id as revenue, c_acctbal as popularity, c_acctbal as vote_average,
    movie_id as vote_count, '/p/' || movie_id as poster_path, '/b/' || movie_id as backdrop_path,
    date '2026-04-05' as snapshot_date
from (select *, substr('ANR', cast(r as int) + 1, 1) as f from {CUSTOMER_DOC}) d join customer on c_custkey = movie_id
""",
    "movie_keywords": f"""
select movie_id, date '2026-04-05' as snapshot_date, case when n <> 7 then movie_id % 100 end as keyword_id,
    case when n <> 7 then 'kw ' || n end as keyword_name from {CUSTOMER_DOC}
""",
    "movie_origin_countries": f"""
select movie_id, date '2026-04-05' as snapshot_date, unnest([f, t, nullif(f, 'A')]) as origin_country_code
from (select *, substr('ANR', cast(r as int) + 1, 1) as f,
    case when snapshot_date = date '{FIRST_DAY}' then 'F' else 'O' end as t from {CUSTOMER_DOC}) d
""",
    "movie_release_dates": f"""
select movie_id, date '2026-04-05' as snapshot_date, f as country_code, case when n > 2 then t end as certification,
    case when n > 2 then lower(f) end as language_code, case when n > 2 then '' end as note,
    case when n > 2 then '2026-04-01T00:00:00.000Z' end as release_datetime, case when n > 2 then n end as release_type,
    case when n > 2 then f || ',' || t end as descriptors
from (select *, substr('ANR', cast(r as int) + 1, 1) as f,
    case when snapshot_date = date '{FIRST_DAY}' then 'F' else 'O' end as t from {CUSTOMER_DOC}) d
""",
}
for _name, _sql in PROTOTYPES.items():
    register("prototype_tables" if _name == "movies" else f"prototype_{_name}", _prototype_table(_name), _sql)


@query(
    "partitioned_day_scan",
    """
select event_id, user_id, cast(ts as date) as snapshot_date from events where cast(ts as date) = date '2024-01-15'
""",
)
def partitioned_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("snapshot_date", day("ts"))
    path = scratch(spark, "events")
    append_days(balanced(events), path)
    return one_day(read_table(spark, path), "2024-01-15").select("event_id", "user_id", "snapshot_date")


@query(
    "constant_day",
    "select doc_id, date '2026-04-05' as snapshot_date, n_chars from documents",
)
def constant_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", day_literal("2026-04-05").alias("snapshot_date"), "n_chars"
    )
