"""The parsed table to 18 flat silver tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapstar.functions.columns import Day, safe_date
from snapstar.operators.explode import explode_child
from snapstar.operators.keyed import dimension, last_seen, one_per_key, supersede
from snapstar.plans.carry import carry, newest
from snapstar.schemas import (
    CHILDREN,
    DIMS,
    DOCUMENT_KEYS,
    FACT_FIELDS,
    HISTORY_TABLES,
    MOVIE_FIELDS,
    PARSED_DDL,
    PERSON_FIELDS,
    names,
)
from snapstar.sinks.write import DAILY_MODES, at_once, overwrite
from snapstar.sources.tables import one_day, read_table


def movies(documents: DataFrame) -> DataFrame:
    """One row per film and day."""
    fields = [safe_date(F.col(c)).alias(c) if c == "release_date" else F.col(c) for c in names(MOVIE_FIELDS)]
    rows = documents.select(F.col("id").alias("movie_id"), "snapshot_date", *fields, "source_file")
    return one_per_key(rows, DOCUMENT_KEYS)


def daily_fact(movie_rows: DataFrame) -> DataFrame:
    """The daily measures of the films; from ``movies``, so both keep the same row."""
    return movie_rows.select(*DOCUMENT_KEYS, *names(FACT_FIELDS))


def child_table(documents: DataFrame, table: str) -> DataFrame:
    """The distinct rows of one nested array."""
    return explode_child(documents, CHILDREN[table]).distinct()


def history_dim(documents: DataFrame, table: str) -> DataFrame:
    """One row per key over all days, as it was last seen."""
    dim = DIMS[table]
    return dimension(explode_child(documents, CHILDREN[dim.child]), names(dim.columns))


def people(documents: DataFrame) -> DataFrame:
    """Everyone credited, from cast and crew together.

    Two branches read different nested columns, so nothing is scanned twice, and
    each reads only the fields of a person, not those of the credit.
    """
    fields = names(PERSON_FIELDS)
    roles = [explode_child(documents, CHILDREN[t], [], only=fields) for t in ("movie_cast", "movie_crew")]
    return roles[0].unionByName(roles[1]).filter(F.col("person_id").isNotNull())


def dim_person(documents: DataFrame) -> DataFrame:
    """Each person once, at their highest popularity."""
    return most_popular(people(documents))


def most_popular(rows: DataFrame) -> DataFrame:
    """One row per person: highest popularity, then name, then the other columns."""
    others = [c for c in names(PERSON_FIELDS)[1:] if c != "person_popularity"]
    return one_per_key(rows, ["person_id"], [F.col("person_popularity").desc_nulls_last()], others)


def silver_table(documents: DataFrame, table: str) -> DataFrame:
    """Any of the 18 tables by name, over the documents given."""
    if table == "movies":
        return movies(documents)
    if table == "fact_movie_daily_snapshot":
        return daily_fact(movies(documents))
    if table == "dim_person":
        return dim_person(documents)
    return child_table(documents, table) if table in CHILDREN else history_dim(documents, table)


_schemas: dict[str, StructType] = {}


def read_silver(spark: SparkSession, silver_root: str, table: str) -> DataFrame:
    """A silver table by its known schema, which files cannot tell while there are none."""
    if table not in _schemas:
        _schemas[table] = silver_table(spark.createDataFrame([], PARSED_DDL), table).schema
    return spark.read.schema(_schemas[table]).parquet(newest(spark, f"{silver_root}/{table}"))


def advance_dim(previous: DataFrame, documents: DataFrame, table: str) -> DataFrame:
    """A dimension after the documents of later days, without reading older ones again."""
    if table == "dim_person":
        return most_popular(previous.unionByName(people(documents)))
    dim = DIMS[table]
    seen = last_seen(explode_child(documents, CHILDREN[dim.child]), names(dim.columns))
    return supersede(previous, seen, names(dim.columns)[:1])


def build_silver(
    spark: SparkSession,
    parsed_path: str,
    silver_root: str,
    day: Day,
    mode: str = "append",
    *,
    state_root: str | None = None,
    parallel: int = 4,
) -> None:
    """Write the day's rows of the 12 daily tables and the 6 dimensions anew.

    Every table reads its own nested columns of the parsed table, so nothing is
    cached. With ``replace_day`` the fact is read back from ``movies``, whose day
    then holds each film once; after appends it may hold several copies, so the
    fact comes from the documents again. Dimensions come from all days, or with
    a ``state_root`` from their last state and the days after it; the last state,
    which ``read_silver`` finds, is then the table, if that root is the silver one.
    """
    history = read_table(spark, parsed_path, PARSED_DDL)
    today = one_day(history, day)
    save = DAILY_MODES[mode]

    def write_films() -> None:
        save(movies(today), f"{silver_root}/movies", day)
        films = movies(today)
        if mode == "replace_day":
            films = one_day(read_silver(spark, silver_root, "movies"), day)
        save(daily_fact(films), f"{silver_root}/fact_movie_daily_snapshot", day)

    def write_child(table: str) -> None:
        save(child_table(today, table), f"{silver_root}/{table}", day)

    def write_dim(table: str) -> None:
        build, advance = partial(silver_table, table=table), partial(advance_dim, table=table)
        if state_root:
            carry(spark, f"{state_root}/{table}", day, history, build, advance)
        else:
            overwrite(build(history), f"{silver_root}/{table}")

    jobs = [write_films, *[partial(write_child, t) for t in CHILDREN], *[partial(write_dim, t) for t in HISTORY_TABLES]]
    at_once(jobs, parallel)
