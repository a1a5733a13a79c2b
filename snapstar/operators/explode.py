"""Nested arrays to flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstar.functions.columns import any_present
from snapstar.schemas import Child, Level, names, pairs


def document_columns() -> list[Column]:
    """What every child row carries from its document."""
    return [F.col("id").alias("movie_id"), F.col("snapshot_date")]


def explode_child(
    documents: DataFrame,
    child: Child,
    carry: list[Column] | None = None,
    *,
    keep_empty: bool = False,
    only: list[str] | None = None,
) -> DataFrame:
    """One row per element of the child's array, nested levels included.

    Elements without any identifier are dropped, so an outer explode would only
    add rows that go again; the inner one lets Catalyst skip empty arrays before
    the generator. ``keep_empty`` instead keeps every document, with nulls.

    ``only`` names the columns wanted of a one-level child, its first identifier
    among them. The array is then put together from those fields alone, since
    Catalyst reads all fields of an exploded struct once two of them are used.
    """
    if only is not None:
        child = _narrowed(child, only)
    rows = documents
    columns = document_columns() if carry is None else carry
    parent = ""
    for level in child.levels:
        unnest = F.explode_outer if keep_empty or level.keep_empty else F.explode
        array = F.col(parent + level.path)
        if only is not None:
            array = F.arrays_zip(*[array[field].alias(field) for field, _ in pairs(level.fields)])
        rows = rows.select(*columns, unnest(array).alias("_item"))
        columns = [F.col(c) for c in rows.columns if c != "_item"] + _fields(level)
        parent = "_item."
    rows = rows.select(*columns)
    return rows if keep_empty else rows.filter(any_present(names(child.identifiers)))


def _fields(level: Level) -> list[Column]:
    item = F.col("_item")
    return [(item if field == "*" else item[field]).alias(column) for field, column in pairs(level.fields)]


def _narrowed(child: Child, only: list[str]) -> Child:
    (level,) = child.levels
    fields = ", ".join(f"{field} as {column}" for field, column in pairs(level.fields) if column in only)
    kept = ", ".join(c for c in names(child.identifiers) if c in only)
    return Child((level._replace(fields=fields),), kept)
