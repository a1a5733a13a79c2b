"""Two starter models and the single-document prototype."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.functions.columns import Day
from snapstar.operators.explode import explode_child
from snapstar.schemas import CHILDREN, MOVIE_FIELDS, names
from snapstar.session import workspace
from snapstar.sinks.write import append
from snapstar.sources.raw import read_inferred


def literal_rows(rows: DataFrame) -> DataFrame:
    """A row with id 1 and a row with a null id; fails its own ``not_null`` check."""
    one = rows.select(F.lit(1).alias("id"))
    return one.union(rows.select(F.lit(None).cast("int").alias("id")))


def first_example(spark: SparkSession) -> DataFrame:
    return literal_rows(spark.range(1))


def second_example(first: DataFrame) -> DataFrame:
    """Only id 1; a null id is not equal to it."""
    return first.filter(F.col("id") == 1)


def flatten_documents(documents: DataFrame) -> dict[str, DataFrame]:
    """The film row and all 10 arrays as they come: no filter, no dedup, empty arrays kept."""
    film = documents.select(F.col("id").alias("movie_id"), *names(MOVIE_FIELDS), "snapshot_date")
    flat = {name: explode_child(documents, child, keep_empty=True) for name, child in CHILDREN.items()}
    countries = flat["movie_origin_countries"].withColumnRenamed("country_code", "origin_country_code")
    return {"movies": film} | flat | {"movie_origin_countries": countries}


def flatten_file(spark: SparkSession, path: str, out_root: str, day: Day) -> None:
    """Flatten documents, schema inferred, into 11 tables.

    Text has no columns to prune: each table would parse every document again,
    so here the parsed rows are kept, on disk where memory ends. The stored texts
    of the files go at the end.
    """
    with workspace(spark):
        documents = read_inferred(spark, path, day, once=True).persist(StorageLevel.MEMORY_AND_DISK)
        for name, rows in flatten_documents(documents).items():
            append(rows, f"{out_root}/{name}")
        documents.unpersist()
