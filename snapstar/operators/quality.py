"""Declared checks: failing rows, violation counts and the report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.functions.columns import all_present
from snapstar.schemas import CHECKS

REPORT_COLUMNS = ["model", "column", "test", "violations"]


def null_rows(rows: DataFrame, column: str) -> DataFrame:
    """Rows that fail ``not_null``."""
    return rows.filter(F.col(column).isNull())


def duplicate_keys(rows: DataFrame, column: str | list[str]) -> DataFrame:
    """Values that fail ``unique``, with their row counts; nulls do not count."""
    columns = [column] if isinstance(column, str) else column
    return rows.filter(all_present(columns)).groupBy(*columns).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def declared_checks(text: str = CHECKS) -> list[tuple[str, str, list[str]]]:
    """``(model, column, tests)`` of a list of ``model column test ...`` lines."""
    lines = [line.split() for line in text.strip().splitlines()]
    return [(model, column, tests) for model, column, *tests in lines]


def check_report(models: Mapping[str, DataFrame], checks: str = CHECKS) -> DataFrame:
    """Violations per declared check, for the models given.

    All ``not_null`` checks of a model share one pass over it; ``unique`` checks
    group by the column alone, combined before the shuffle.
    """
    not_null: dict[str, list[str]] = {}
    unique: list[tuple[str, str]] = []
    for model, column, tests in declared_checks(checks):
        if model not in models:
            continue
        if "not_null" in tests:
            not_null.setdefault(model, []).append(column)
        if "unique" in tests:
            unique.append((model, column))
    reports = [_null_counts(models[model], model, columns) for model, columns in not_null.items()]
    reports += [_duplicate_count(models[model], model, column) for model, column in unique]
    return reduce(DataFrame.unionByName, reports)


def _null_counts(rows: DataFrame, model: str, columns: list[str]) -> DataFrame:
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    unpivoted = counts.unpivot([], columns, "column", "violations")
    return unpivoted.select(F.lit(model).alias("model"), "column", F.lit("not_null").alias("test"), "violations")


def _duplicate_count(rows: DataFrame, model: str, column: str) -> DataFrame:
    return (
        duplicate_keys(rows, column)
        .agg(F.count("*").alias("violations"))
        .select(F.lit(model).alias("model"), F.lit(column).alias("column"), F.lit("unique").alias("test"), "violations")
    )
