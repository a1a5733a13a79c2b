"""The names and types every job agrees on.

Everything here is data. A column list is written as text, ``field as column``
where the stored name differs from the document's field name.
"""

from __future__ import annotations

from typing import NamedTuple

# --- raw document -----------------------------------------------------------
# One JSON object per film and day. Every field may be missing or null.
DOCUMENT_DDL = """
adult boolean, backdrop_path string, belongs_to_collection string, budget bigint,
genres array<struct<id: bigint, name: string>>,
homepage string, id bigint, imdb_id string, origin_country array<string>,
original_language string, original_title string, overview string, popularity double, poster_path string,
production_companies array<struct<id: bigint, logo_path: string, name: string, origin_country: string>>,
production_countries array<struct<iso_3166_1: string, name: string>>,
release_date string, revenue bigint, runtime bigint,
spoken_languages array<struct<english_name: string, iso_639_1: string, name: string>>,
status string, tagline string, title string, video boolean, vote_average double, vote_count bigint,
credits struct<
  cast: array<struct<adult: boolean, cast_id: bigint, character: string, credit_id: string, gender: bigint,
    id: bigint, known_for_department: string, name: string, `order`: bigint, original_name: string,
    popularity: double, profile_path: string>>,
  crew: array<struct<adult: boolean, credit_id: string, department: string, gender: bigint, id: bigint,
    job: string, known_for_department: string, name: string, original_name: string,
    popularity: double, profile_path: string>>>,
keywords struct<keywords: array<struct<id: bigint, name: string>>>,
release_dates struct<results: array<struct<iso_3166_1: string, release_dates: array<struct<
    certification: string, descriptors: array<string>, iso_639_1: string, note: string,
    release_date: string, type: bigint>>>>>,
videos struct<results: array<struct<id: string, iso_639_1: string, iso_3166_1: string, key: string, name: string,
    official: boolean, published_at: string, site: string, size: bigint, type: string>>>
"""

# Landed raw documents, and the same after parsing.
RAW_DDL = "movie_id bigint, raw_json string, source_file string, snapshot_date date"
PARSED_DDL = f"source_file string, raw_json string, {DOCUMENT_DDL}, snapshot_date date"

# One page of a discovery listing.
DISCOVERY_DDL = """
page bigint, total_pages bigint,
results array<struct<id: bigint, title: string, release_date: string, adult: boolean, video: boolean>>
"""

# --- silver: one row per film and day ----------------------------------------
MOVIE_FIELDS = """
title, original_title, original_language, overview, homepage, imdb_id, release_date, runtime, status,
tagline, adult, video, budget, revenue, popularity, vote_average, vote_count, poster_path, backdrop_path
"""
FACT_FIELDS = "popularity, vote_average, vote_count, revenue, runtime, status"


# --- silver: one row per array element ----------------------------------------
class Level(NamedTuple):
    """One array to unnest. ``keep_empty`` keeps a parent whose array has no rows."""

    path: str
    fields: str
    keep_empty: bool = False


class Child(NamedTuple):
    """A flat table made from an array; a row needs one of ``identifiers``."""

    levels: tuple[Level, ...]
    identifiers: str


CHILDREN = {
    "movie_genres": Child(
        (Level("genres", "id as genre_id, name as genre_name"),),
        "genre_id, genre_name",
    ),
    "movie_production_companies": Child(
        (
            Level(
                "production_companies",
                "id as company_id, name as company_name, origin_country as company_origin_country, "
                "logo_path as company_logo_path",
            ),
        ),
        "company_id, company_name",
    ),
    "movie_production_countries": Child(
        (Level("production_countries", "iso_3166_1 as country_code, name as country_name"),),
        "country_code, country_name",
    ),
    "movie_spoken_languages": Child(
        (
            Level(
                "spoken_languages",
                "iso_639_1 as language_code, english_name as language_english_name, name as language_name",
            ),
        ),
        "language_code, language_name, language_english_name",
    ),
    # An array of plain strings: the element itself is the column.
    "movie_origin_countries": Child((Level("origin_country", "* as country_code"),), "country_code"),
    "movie_cast": Child(
        (
            Level(
                "credits.cast",
                "id as person_id, name as person_name, original_name, gender, known_for_department, character, "
                "order as cast_order, cast_id, credit_id, profile_path, popularity as person_popularity, adult",
            ),
        ),
        "person_id, person_name",
    ),
    "movie_crew": Child(
        (
            Level(
                "credits.crew",
                "id as person_id, name as person_name, original_name, gender, known_for_department, department, "
                "job, credit_id, profile_path, popularity as person_popularity, adult",
            ),
        ),
        "person_id, person_name",
    ),
    "movie_keywords": Child(
        (Level("keywords.keywords", "id as keyword_id, name as keyword_name"),),
        "keyword_id, keyword_name",
    ),
    # A country without release items stays, as a row with null item columns.
    "movie_release_dates": Child(
        (
            Level("release_dates.results", "iso_3166_1 as country_code"),
            Level(
                "release_dates",
                "certification, iso_639_1 as language_code, note, release_date as release_datetime, "
                "type as release_type, descriptors",
                keep_empty=True,
            ),
        ),
        "country_code, release_datetime",
    ),
    "movie_videos": Child(
        (
            Level(
                "videos.results",
                "id as video_id, iso_639_1 as language_code, iso_3166_1 as country_code, key as video_key, "
                "name as video_name, site, size, type as video_type, official, published_at",
            ),
        ),
        "video_id, video_key",
    ),
}


# --- silver: one row per key over all days --------------------------------------
class Dim(NamedTuple):
    """A dimension over the rows of ``child``; its key is the first column."""

    child: str
    columns: str


DIMS = {
    "dim_genre": Dim("movie_genres", "genre_id, genre_name"),
    "dim_company": Dim(
        "movie_production_companies",
        "company_id, company_name, company_origin_country, company_logo_path",
    ),
    "dim_language": Dim("movie_spoken_languages", "language_code, language_english_name, language_name"),
    "dim_country": Dim("movie_production_countries", "country_code, country_name"),
    "dim_keyword": Dim("movie_keywords", "keyword_id, keyword_name"),
}
PERSON_FIELDS = (
    "person_id, person_name, original_name, gender, known_for_department, profile_path, person_popularity, adult"
)

# --- staging: typed views over silver -----------------------------------------
# ``column type`` is a cast, a bare column passes through.
STAGING = {
    "stg_movies": (
        "movies",
        "movie_id bigint, snapshot_date date, title, original_title, original_language, overview, homepage, "
        "imdb_id, release_date date, runtime bigint, status, tagline, adult boolean, video boolean, "
        "budget bigint, revenue bigint, popularity double, vote_average double, vote_count bigint, "
        "poster_path, backdrop_path, source_file",
    ),
    "stg_fact_movie_daily_snapshot": (
        "fact_movie_daily_snapshot",
        "movie_id bigint, snapshot_date date, popularity double, vote_average double, vote_count bigint, "
        "revenue bigint, runtime bigint, status",
    ),
    "stg_movie_genres": (
        "movie_genres",
        "movie_id bigint, snapshot_date date, genre_id bigint, genre_name",
    ),
    "stg_movie_cast": (
        "movie_cast",
        "movie_id bigint, snapshot_date date, person_id bigint, person_name, original_name, gender bigint, "
        "known_for_department, character, cast_order bigint, credit_id, profile_path, "
        "person_popularity double, adult boolean",
    ),
    "stg_movie_crew": (
        "movie_crew",
        "movie_id bigint, snapshot_date date, person_id bigint, person_name, original_name, gender bigint, "
        "known_for_department, department, job, credit_id, profile_path, person_popularity double, adult boolean",
    ),
    "stg_dim_company": (
        "dim_company",
        "company_id bigint, company_name, company_origin_country, company_logo_path",
    ),
    "stg_dim_country": ("dim_country", "country_code, country_name"),
    "stg_dim_genre": ("dim_genre", "genre_id bigint, genre_name"),
    "stg_dim_keyword": ("dim_keyword", "keyword_id bigint, keyword_name"),
    "stg_dim_language": ("dim_language", "language_code, language_english_name, language_name"),
    "stg_dim_person": (
        "dim_person",
        "person_id bigint, person_name, original_name, gender bigint, known_for_department, profile_path, "
        "person_popularity double, adult boolean",
    ),
}
# Rows of these views need this column.
STAGING_REQUIRED = {
    "stg_movie_crew": "person_id",
    "stg_dim_company": "company_id",
    "stg_dim_country": "country_code",
    "stg_dim_genre": "genre_id",
    "stg_dim_keyword": "keyword_id",
    "stg_dim_language": "language_code",
    "stg_dim_person": "person_id",
}

# --- marts ----------------------------------------------------------------------
DIM_MOVIE_COLUMNS = """
movie_id, title, original_title, original_language, overview, homepage, imdb_id, release_date, runtime,
status, tagline, adult, video, budget, poster_path, backdrop_path
"""
BRIDGE_CAST_COLUMNS = "movie_id, person_id, character, cast_order, credit_id"
BRIDGE_CREW_COLUMNS = "movie_id, person_id, department, job, credit_id"
BRIDGE_GENRE_COLUMNS = "movie_id, genre_id"
CREDIT_KEYS = ["movie_id", "person_id", "credit_id"]
DOCUMENT_KEYS = ["movie_id", "snapshot_date"]

# The fact table admits days after this one while it is still empty.
DEFAULT_MARK = "2026-01-01"

# --- publishing -------------------------------------------------------------------
DAILY_TABLES = ["movies", "fact_movie_daily_snapshot", *CHILDREN]
HISTORY_TABLES = ["dim_genre", "dim_company", "dim_keyword", "dim_language", "dim_country", "dim_person"]
SILVER_TABLES = DAILY_TABLES + HISTORY_TABLES
# The silver tables that the models may read.
SOURCES = [
    "movies",
    "fact_movie_daily_snapshot",
    "movie_genres",
    "movie_cast",
    "movie_crew",
    "movie_keywords",
    "movie_production_companies",
    "dim_genre",
    "dim_person",
    "dim_company",
    "dim_country",
    "dim_language",
    "dim_keyword",
]

# --- declared checks: model, column, tests ---------------------------------------------
CHECKS = """
dim_movie movie_id not_null unique
dim_genre genre_id not_null unique
dim_person person_id not_null unique
fct_movie_daily_snapshot movie_id not_null
fct_movie_daily_snapshot snapshot_date not_null
bridge_movie_genre movie_id not_null
bridge_movie_genre genre_id not_null
bridge_movie_cast movie_id not_null
bridge_movie_cast person_id not_null
dim_company company_id not_null unique
dim_keyword keyword_id not_null unique
dim_country country_code not_null unique
dim_language language_code not_null unique
bridge_movie_crew movie_id not_null
bridge_movie_crew person_id not_null
stg_movies movie_id not_null
stg_movies snapshot_date not_null
stg_fact_movie_daily_snapshot movie_id not_null
stg_fact_movie_daily_snapshot snapshot_date not_null
stg_movie_genres movie_id not_null
stg_movie_genres genre_id not_null
first_example id not_null unique
second_example id not_null unique
"""


def names(text: str) -> list[str]:
    """Column names of a comma-separated list."""
    return [part.strip() for part in text.split(",")]


def pairs(text: str) -> list[tuple[str, str]]:
    """``(field, column)`` pairs of a ``field as column`` list."""
    split = [part.split(" as ") for part in names(text)]
    return [(s[0], s[-1]) for s in split]
