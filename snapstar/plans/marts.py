"""Staging views, dimensions, bridges and the incremental fact."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapstar.functions.columns import Day, all_present
from snapstar.operators.incremental import rows_of_same_days
from snapstar.operators.keyed import latest_per_key, one_per_key, supersede, upsert_marked
from snapstar.plans.silver import most_popular
from snapstar.schemas import (
    BRIDGE_CAST_COLUMNS,
    BRIDGE_CREW_COLUMNS,
    BRIDGE_GENRE_COLUMNS,
    CREDIT_KEYS,
    DEFAULT_MARK,
    DIM_MOVIE_COLUMNS,
    DOCUMENT_KEYS,
    FACT_FIELDS,
    PERSON_FIELDS,
    STAGING,
    STAGING_REQUIRED,
    names,
)
from snapstar.sinks.write import DAY, balanced, overwrite, replace_days
from snapstar.sources.tables import one_day, partition_values, read_if_exists

FACT, FACT_VIEW = "fct_movie_daily_snapshot", "stg_fact_movie_daily_snapshot"
FACT_DDL = (
    "movie_id bigint, popularity double, vote_average double, vote_count bigint, revenue bigint, runtime bigint, "
    "status string, snapshot_date date"
)


# --- staging ---------------------------------------------------------------------
def staging_view(source: DataFrame, columns: str, required: str | None = None) -> DataFrame:
    """The listed columns, cast where a type is given, of rows that have ``required``."""
    rows = source.filter(F.col(required).isNotNull()) if required else source
    typed = [c.split() for c in names(columns)]
    return rows.select(*[F.col(c[0]).cast(c[1]).alias(c[0]) if c[1:] else F.col(c[0]) for c in typed])


def staging(sources: Mapping[str, DataFrame], view: str) -> DataFrame:
    source, columns = STAGING[view]
    return staging_view(sources[source], columns, STAGING_REQUIRED.get(view))


def view_sql(view: str, database: str) -> str:
    """The view in SQL, over the published table of a database."""
    source, columns = STAGING[view]
    typed = [c.split() for c in names(columns)]
    listed = ", ".join(f"CAST({c[0]} AS {c[1]}) AS {c[0]}" if c[1:] else c[0] for c in typed)
    required = STAGING_REQUIRED.get(view)
    return f"SELECT {listed} FROM `{database}`.`{source}`" + (f" WHERE {required} IS NOT NULL" if required else "")


def create_views(spark: SparkSession, database: str, views: Iterable[str] = STAGING) -> None:
    """Keep the views in the database, for every session; one that is there is replaced."""
    for view in views:
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{view}` AS {view_sql(view, database)}")


def build_staging(sources: Mapping[str, DataFrame], *, register: bool = False) -> dict[str, DataFrame]:
    """The 11 typed views; ``register`` also makes them visible to SQL."""
    views = {view: staging(sources, view) for view in STAGING}
    if register:
        for name, rows in views.items():
            rows.createOrReplaceTempView(name)
    return views


# --- dimensions --------------------------------------------------------------------
def distinct_dim(staged: DataFrame) -> DataFrame:
    """The distinct rows that have a key, which is the first column."""
    return staged.filter(F.col(staged.columns[0]).isNotNull()).distinct()


def dim_movie(staged: DataFrame) -> DataFrame:
    """Each film as of its last day."""
    return latest_per_key(staged, ["movie_id"]).select(*names(DIM_MOVIE_COLUMNS))


def dim_person(staged: DataFrame) -> DataFrame:
    """Each person at their highest popularity, names breaking ties."""
    return most_popular(staged).select(*names(PERSON_FIELDS))


# --- bridges ---------------------------------------------------------------------------
def credits(staged: DataFrame, columns: str) -> DataFrame:
    """Every version of each credit. A rank over keys cannot change which of them are null: filter before it."""
    return staged.filter(all_present(["movie_id", "person_id"])).select(*names(columns), DAY)


def credit_bridge(staged: DataFrame, columns: str) -> DataFrame:
    """The last version of each credit; credits that vanished upstream stay."""
    return latest_per_key(credits(staged, columns), CREDIT_KEYS).select(*names(columns))


def genre_bridge(staged: DataFrame) -> DataFrame:
    pair = names(BRIDGE_GENRE_COLUMNS)
    return staged.filter(all_present(pair)).select(*pair).distinct()


def cast_bridge(staged: DataFrame) -> DataFrame:
    return credit_bridge(staged, BRIDGE_CAST_COLUMNS)


def crew_bridge(staged: DataFrame) -> DataFrame:
    return credit_bridge(staged, BRIDGE_CREW_COLUMNS)


# Each mart that is rebuilt as a whole: the view it reads, and how.
DIMENSIONS = {
    "dim_company": ("stg_dim_company", distinct_dim),
    "dim_country": ("stg_dim_country", distinct_dim),
    "dim_genre": ("stg_dim_genre", distinct_dim),
    "dim_keyword": ("stg_dim_keyword", distinct_dim),
    "dim_language": ("stg_dim_language", distinct_dim),
    "dim_movie": ("stg_movies", dim_movie),
    "dim_person": ("stg_dim_person", dim_person),
}
BRIDGES = {
    "bridge_movie_cast": ("stg_movie_cast", cast_bridge),
    "bridge_movie_crew": ("stg_movie_crew", crew_bridge),
    "bridge_movie_genre": ("stg_movie_genres", genre_bridge),
}


# --- fact --------------------------------------------------------------------------------
def fact_rows(staged: DataFrame) -> DataFrame:
    return staged.select(*DOCUMENT_KEYS, *names(FACT_FIELDS))


def advance_fact(
    spark: SparkSession, staged: DataFrame, path: str, *, full_refresh: bool = False, keep_duplicates: bool = False
) -> None:
    """Bring the fact table up to date with the days it does not have yet.

    The first run takes every row. Later runs take only days after the last one,
    which the table's folders name, and write them as new day folders: no row of
    the table has their key, so the merge needs neither a join nor a rewrite, and
    no file of the table is opened. Duplicate keys within the new days are merged
    to one row unless ``keep_duplicates``.
    """
    rows = fact_rows(staged)
    if full_refresh or read_if_exists(spark, path, FACT_DDL) is None:
        overwrite(balanced(rows), path, by=DAY)
        return
    last = max(partition_values(spark, path, DAY), default=DEFAULT_MARK)
    rows = rows.filter(F.col(DAY) > F.lit(last).cast("date"))
    replace_days(balanced(rows if keep_duplicates else one_per_key(rows, DOCUMENT_KEYS)), path)


def merge_days(
    spark: SparkSession, delta: DataFrame, path: str, ddl: str, keys: list[str] = DOCUMENT_KEYS, day: Day = None
) -> int:
    """Merge rows into a table partitioned by day; rewrites only the days they touch, which is ``day`` if it is given.

    Returns how many rows of the delta the table has now, counted as they are written.
    """
    seen, target = Observation(), read_if_exists(spark, path, ddl)
    if target is None:
        rows = one_per_key(delta, keys).observe(seen, F.count("*").alias("n"))
        overwrite(balanced(rows), path, by=DAY)
        return seen.get["n"]
    touched = rows_of_same_days(target, delta) if day is None else one_day(target, day)
    merged = upsert_marked(touched, delta, keys).observe(seen, F.count_if("_new").alias("n"))
    replace_days(balanced(merged.select(*target.columns)), path)
    return seen.get["n"]


# --- later days on top of a finished table -----------------------------------------------------
def advance_dim_movie(previous: DataFrame, staged_days: DataFrame) -> DataFrame:
    """The film dimension after later days, without reading older ones again."""
    return supersede(previous, staged_days, ["movie_id"])


def advance_cast_bridge(previous: DataFrame, staged_days: DataFrame) -> DataFrame:
    return supersede(previous, credits(staged_days, BRIDGE_CAST_COLUMNS), CREDIT_KEYS)


def advance_crew_bridge(previous: DataFrame, staged_days: DataFrame) -> DataFrame:
    return supersede(previous, credits(staged_days, BRIDGE_CREW_COLUMNS), CREDIT_KEYS)


def advance_genre_bridge(previous: DataFrame, staged_days: DataFrame) -> DataFrame:
    return previous.unionByName(genre_bridge(staged_days)).distinct()


# Marts over all days that can go on from their last state.
ADVANCE = {
    "dim_movie": advance_dim_movie,
    "bridge_movie_cast": advance_cast_bridge,
    "bridge_movie_crew": advance_crew_bridge,
    "bridge_movie_genre": advance_genre_bridge,
}
