"""The 18 silver tables, 11 staging views, 7 dimensions and 3 bridges over documents made from lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapstar.catalog.base import register
from snapstar.catalog.shapes import films
from snapstar.operators.explode import explode_child
from snapstar.plans import marts, silver
from snapstar.schemas import CHILDREN, SILVER_TABLES, STAGING

# One row per document. The columns are what the other queries are made of.
DOC = """
(select l_orderkey as movie_id,
    case l_linestatus when 'F' then date '2026-04-08' else date '2026-04-09' end as snapshot_date,
    cast(l_linenumber as bigint) as n, l_partkey as p, l_suppkey as s, l_returnflag as f, l_linestatus as t,
    l_extendedprice as price, l_quantity as quantity, l_discount as discount, cast(l_shipdate as date) as shipped,
    strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00.000Z' as shipped_at
from lineitem) doc
"""

MOVIES = f"""
select movie_id, snapshot_date, 'Line ' || n || ' of ' || movie_id as title, 'Order ' || movie_id as original_title,
    lower(f) as original_language, 'part ' || p || ' from ' || s as overview,
    case when n = 4 then '/h/' || p end as homepage, 'tt' || movie_id as imdb_id,
    case when n > 3 then shipped end as release_date, n as runtime, t as status, nullif(f, 'N') as tagline,
    f = 'R' as adult, t = 'F' as video, p * 10 as budget, s as revenue, price as popularity,
    discount as vote_average, p as vote_count, '/p/' || p as poster_path, '/b/' || p as backdrop_path,
    'snapshot/' || movie_id as source_file
from {DOC}
qualify row_number() over (partition by movie_id, snapshot_date order by
    title nulls first, original_title nulls first, original_language nulls first, overview nulls first,
    homepage nulls first, imdb_id nulls first, release_date nulls first, runtime nulls first, status nulls first,
    tagline nulls first, adult nulls first, video nulls first, budget nulls first, revenue nulls first,
    popularity nulls first, vote_average nulls first, vote_count nulls first) = 1
"""

CAST_COLUMNS = """
p as person_id, 'Part ' || p as person_name, 'part ' || p as original_name, n % 3 as gender,
'Acting' as known_for_department, 'Role ' || f as character, n as cast_order, n as cast_id, 'a' || n as credit_id,
case when n = 5 then '/f/' || p end as profile_path, price as person_popularity, f = 'A' as adult
"""
SUPPLIER_COLUMNS = """
s as person_id, 'Supplier ' || s as person_name, 'supplier ' || s as original_name, cast(0 as bigint) as gender,
'Supply' as known_for_department, 'Supply' as department, 'Job ' || f as job, 's' || n as credit_id,
'/s/' || s as profile_path, quantity as person_popularity, false as adult
"""
WRITER_COLUMNS = """
p as person_id, 'Part ' || p as person_name, 'part ' || p as original_name, cast(1 as bigint) as gender,
'Writing' as known_for_department, 'Writing' as department, 'Writer' as job, 'w' as credit_id,
cast(null as varchar) as profile_path, cast(null as double) as person_popularity, false as adult
"""
KEY = "movie_id, snapshot_date"
GENRES = f"""
select {KEY}, cast(ascii(f) as bigint) as genre_id, f as genre_name from {DOC}
union all select {KEY}, nullif(n, 1), 'Line ' || n from {DOC}
"""
COMPANIES = f"""
select {KEY}, s as company_id, 'Supplier ' || s as company_name, f as company_origin_country,
    '/l/' || (s % 7) as company_logo_path from {DOC}
"""
COUNTRIES = f"select {KEY}, f || t as country_code, 'Country ' || n as country_name from {DOC}"
LANGUAGES = f"""
select {KEY}, lower(f) as language_code, 'Lang ' || f as language_english_name,
    case when n <> 1 then 'L' || n end as language_name from {DOC}
"""
ORIGINS = f"""
select {KEY}, f as country_code from {DOC} union all select {KEY}, t from {DOC}
"""
KEYWORDS = f"select {KEY}, p % 100 as keyword_id, 'kw ' || n as keyword_name from {DOC} where n <> 7"
CAST = f"select {KEY}, {CAST_COLUMNS} from {DOC}"
CREW = f"select {KEY}, {SUPPLIER_COLUMNS} from {DOC} union all select {KEY}, {WRITER_COLUMNS} from {DOC}"
RELEASES = f"""
select {KEY}, f as country_code, case when n > 2 then t end as certification,
    case when n > 2 then lower(f) end as language_code, case when n > 2 then '' end as note,
    case when n > 2 then shipped_at end as release_datetime, case when n > 2 then n end as release_type,
    case when n > 2 then f || ',' || t end as descriptors from {DOC}
"""
VIDEOS = f"""
select {KEY}, 'v' || p as video_id, lower(f) as language_code, t as country_code, 'k' || p as video_key,
    'Video ' || n as video_name, 'Site' as site, n * 100 as size, 'Trailer' as video_type, f = 'N' as official,
    shipped_at as published_at from {DOC} where n % 2 = 1
"""


def _last(rows: str, key: str, others: list[str]) -> str:
    """One row per key: the attributes with the latest day, ties by the attributes."""
    ties = ", ".join(f"{c} nulls first" for c in others)
    columns = ", ".join([key, *others])
    return f"""
select {columns} from (select {columns}, max(snapshot_date) as last_day from ({rows}) r group by {columns}) g
qualify row_number() over (partition by {key} order by last_day desc, {ties}) = 1
"""


PERSON = "person_id, person_name, original_name, gender, known_for_department, profile_path, person_popularity, adult"


def _top_person(rows: str) -> str:
    return f"""
select {PERSON} from ({rows}) r
qualify row_number() over (partition by person_id order by person_popularity desc nulls last,
    person_name nulls first, original_name nulls first, gender nulls first, known_for_department nulls first,
    profile_path nulls first, adult nulls first) = 1
"""


SILVER_SQL = {
    "movies": MOVIES,
    "fact_movie_daily_snapshot": f"""
select movie_id, snapshot_date, popularity, vote_average, vote_count, revenue, runtime, status from ({MOVIES}) m
""",
    "movie_genres": f"select distinct * from ({GENRES}) r",
    "movie_production_companies": f"select distinct * from ({COMPANIES}) r",
    "movie_production_countries": f"select distinct * from ({COUNTRIES}) r",
    "movie_spoken_languages": f"select distinct * from ({LANGUAGES}) r",
    "movie_origin_countries": f"select distinct * from ({ORIGINS}) r",
    "movie_cast": f"select distinct * from ({CAST}) r",
    "movie_crew": f"select distinct * from ({CREW}) r",
    "movie_keywords": f"select distinct * from ({KEYWORDS}) r",
    "movie_release_dates": f"select distinct * from ({RELEASES}) r",
    "movie_videos": f"select distinct * from ({VIDEOS}) r",
    "dim_genre": _last(GENRES, "genre_id", ["genre_name"]),
    "dim_company": _last(COMPANIES, "company_id", ["company_name", "company_origin_country", "company_logo_path"]),
    "dim_language": _last(LANGUAGES, "language_code", ["language_english_name", "language_name"]),
    "dim_country": _last(COUNTRIES, "country_code", ["country_name"]),
    "dim_keyword": _last(KEYWORDS, "keyword_id", ["keyword_name"]),
    "dim_person": _top_person(
        f"select {PERSON} from ({CAST}) a union all select {PERSON} from ({CREW}) b"
    ),
}


# Written out in full, so that a column, cast or filter that the code loses is missing on one side only.
STAGING_SQL = {
    "stg_movies": f"""
select cast(movie_id as bigint) as movie_id, cast(snapshot_date as date) as snapshot_date, title, original_title,
    original_language, overview, homepage, imdb_id, cast(release_date as date) as release_date,
    cast(runtime as bigint) as runtime, status, tagline, cast(adult as boolean) as adult,
    cast(video as boolean) as video, cast(budget as bigint) as budget, cast(revenue as bigint) as revenue,
    cast(popularity as double) as popularity, cast(vote_average as double) as vote_average,
    cast(vote_count as bigint) as vote_count, poster_path, backdrop_path, source_file
from ({SILVER_SQL["movies"]}) s
""",
    "stg_fact_movie_daily_snapshot": f"""
select cast(movie_id as bigint) as movie_id, cast(snapshot_date as date) as snapshot_date,
    cast(popularity as double) as popularity, cast(vote_average as double) as vote_average,
    cast(vote_count as bigint) as vote_count, cast(revenue as bigint) as revenue, cast(runtime as bigint) as runtime,
    status
from ({SILVER_SQL["fact_movie_daily_snapshot"]}) s
""",
    "stg_movie_genres": f"""
select cast(movie_id as bigint) as movie_id, cast(snapshot_date as date) as snapshot_date,
    cast(genre_id as bigint) as genre_id, genre_name
from ({SILVER_SQL["movie_genres"]}) s
""",
    "stg_movie_cast": f"""
select cast(movie_id as bigint) as movie_id, cast(snapshot_date as date) as snapshot_date,
    cast(person_id as bigint) as person_id, person_name, original_name, cast(gender as bigint) as gender,
    known_for_department, character, cast(cast_order as bigint) as cast_order, credit_id, profile_path,
    cast(person_popularity as double) as person_popularity, cast(adult as boolean) as adult
from ({SILVER_SQL["movie_cast"]}) s
""",
    "stg_movie_crew": f"""
select cast(movie_id as bigint) as movie_id, cast(snapshot_date as date) as snapshot_date,
    cast(person_id as bigint) as person_id, person_name, original_name, cast(gender as bigint) as gender,
    known_for_department, department, job, credit_id, profile_path,
    cast(person_popularity as double) as person_popularity, cast(adult as boolean) as adult
from ({SILVER_SQL["movie_crew"]}) s where person_id is not null
""",
    "stg_dim_company": f"""
select cast(company_id as bigint) as company_id, company_name, company_origin_country, company_logo_path
from ({SILVER_SQL["dim_company"]}) s where company_id is not null
""",
    "stg_dim_country": f"""
select country_code, country_name from ({SILVER_SQL["dim_country"]}) s where country_code is not null
""",
    "stg_dim_genre": f"""
select cast(genre_id as bigint) as genre_id, genre_name from ({SILVER_SQL["dim_genre"]}) s where genre_id is not null
""",
    "stg_dim_keyword": f"""
select cast(keyword_id as bigint) as keyword_id, keyword_name
from ({SILVER_SQL["dim_keyword"]}) s where keyword_id is not null
""",
    "stg_dim_language": f"""
select language_code, language_english_name, language_name
from ({SILVER_SQL["dim_language"]}) s where language_code is not null
""",
    "stg_dim_person": f"""
select cast(person_id as bigint) as person_id, person_name, original_name, cast(gender as bigint) as gender,
    known_for_department, profile_path, cast(person_popularity as double) as person_popularity,
    cast(adult as boolean) as adult
from ({SILVER_SQL["dim_person"]}) s where person_id is not null
""",
}

MART_SQL = {
    "dim_company": f"select distinct * from ({STAGING_SQL['stg_dim_company']}) v where company_id is not null",
    "dim_country": f"select distinct * from ({STAGING_SQL['stg_dim_country']}) v where country_code is not null",
    "dim_genre": f"select distinct * from ({STAGING_SQL['stg_dim_genre']}) v where genre_id is not null",
    "dim_keyword": f"select distinct * from ({STAGING_SQL['stg_dim_keyword']}) v where keyword_id is not null",
    "dim_language": f"select distinct * from ({STAGING_SQL['stg_dim_language']}) v where language_code is not null",
    "dim_movie": f"""
select movie_id, title, original_title, original_language, overview, homepage, imdb_id, release_date, runtime,
    status, tagline, adult, video, budget, poster_path, backdrop_path
from ({STAGING_SQL["stg_movies"]}) v
qualify row_number() over (partition by movie_id order by snapshot_date desc) = 1
""",
    "dim_person": _top_person(STAGING_SQL["stg_dim_person"]),
    "bridge_movie_cast": f"""
select movie_id, person_id, character, cast_order, credit_id from ({STAGING_SQL["stg_movie_cast"]}) v
where movie_id is not null and person_id is not null
qualify row_number() over (partition by movie_id, person_id, credit_id
    order by snapshot_date desc, character nulls first, cast_order nulls first) = 1
""",
    "bridge_movie_crew": f"""
select movie_id, person_id, department, job, credit_id from ({STAGING_SQL["stg_movie_crew"]}) v
where movie_id is not null and person_id is not null
qualify row_number() over (partition by movie_id, person_id, credit_id
    order by snapshot_date desc, department nulls first, job nulls first) = 1
""",
    "bridge_movie_genre": f"""
select distinct movie_id, genre_id from ({STAGING_SQL["stg_movie_genres"]}) v
where movie_id is not null and genre_id is not null
""",
}


def silver_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return silver.silver_table(films(spark, sf_dir), table)


def staged_rows(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    source = STAGING[view][0]
    return marts.staging({source: silver_rows(spark, sf_dir, source)}, view)


def mart_rows(spark: SparkSession, sf_dir: str, mart: str) -> DataFrame:
    view, build = (marts.DIMENSIONS | marts.BRIDGES)[mart]
    return build(staged_rows(spark, sf_dir, view))


def _flat(rows: DataFrame) -> DataFrame:
    """Arrays as text, so that results compare in any engine."""
    if "descriptors" not in rows.columns:
        return rows
    return rows.withColumn("descriptors", rows["descriptors"].cast("string")).selectExpr(
        *[c for c in rows.columns if c != "descriptors"],
        "replace(trim(both '[]' from descriptors), ', ', ',') as descriptors",
    )


def _prototype(table: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _flat(explode_child(films(spark, sf_dir), CHILDREN[table], keep_empty=True))

    return run


for _name in SILVER_TABLES:
    register(f"silver_{_name}", lambda s, d, n=_name: _flat(silver_rows(s, d, n)), SILVER_SQL[_name])
for _name in STAGING:
    register(_name, lambda s, d, n=_name: staged_rows(s, d, n), STAGING_SQL[_name])
for _name in MART_SQL:
    register(f"mart_{_name}", lambda s, d, n=_name: mart_rows(s, d, n), MART_SQL[_name])

# The prototype keeps what the silver tables drop: empty arrays and elements without identifiers.
register(
    "outer_genres",
    _prototype("movie_genres"),
    f"{GENRES} union all select {KEY}, null, null from {DOC}",
)
register(
    "outer_keywords",
    _prototype("movie_keywords"),
    f"{KEYWORDS} union all select {KEY}, null, null from {DOC} where n = 7",
)
register("outer_release_dates", _prototype("movie_release_dates"), RELEASES)
