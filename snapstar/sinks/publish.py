"""Publishing tables to a database, with an audit of what was loaded.

Rows are written beside the live table and checked there. Only then the catalog
is pointed to them: by the location of the table, or of each day. A load that
fails, or whose rows fail a check, leaves the table as it was. A table may also
be linked: its days are then the folders of another table, and nothing is copied.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from snapstar.functions.columns import Day, run_date
from snapstar.operators.quality import check_report, declared_checks
from snapstar.schemas import DAILY_TABLES
from snapstar.session import remove
from snapstar.sinks.write import DAY, PACKED, at_once
from snapstar.sources.tables import NULL, one_day, partition_values

AUDIT_DDL = "table_name string, status string, num_rows bigint, error string"
#: Loads of a table, or of a day, that stay: readers of the one before the last can finish.
KEPT = 2


class CheckFailed(ValueError):
    """Staged rows fail a declared check."""


def ensure_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")


def publish_table(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    *,
    location: str,
    replace: bool = True,
    by_day: bool = False,
    day: Day = None,
    checks: str = "",
) -> int:
    """Load the rows into the table, created if needed; returns its row count.

    With a ``day``, which needs ``by_day``, only that day is replaced, and counted.
    ``checks``, lines as in ``declared_checks``, are those of the table's own name.
    With ``replace=False`` rows are added to the live files. Counts come from file
    footers, no column is read.
    """
    rows = rows if day is None else one_day(rows, day)
    number = max(map(int, partition_values(spark, location, "load")), default=0) + 1
    folder = f"{location}/load={number}"
    live = spark.catalog.tableExists(table)
    try:
        if replace or checks or not live:
            writer = rows.write.options(**PACKED).mode("overwrite")
            (writer.partitionBy(DAY) if by_day else writer).parquet(folder)
            staged = spark.read.schema(rows.schema).parquet(folder)
            _check(staged, table, checks)
    except Exception:
        remove(spark, folder)
        raise
    if replace or not live:
        _point(spark, table, rows.schema, folder, location, by_day, day)
    else:
        added = staged if checks else rows
        added.select(*spark.table(table).columns).write.mode("append").insertInto(table)
        remove(spark, folder)
    _retire(spark, table, location, by_day)
    return _count(spark, table, day)


def link_table(spark: SparkSession, path: str, table: str, *, location: str, by_day: bool = False, day: Day = None) -> int:
    """Make the files under ``path`` the table, or with a ``day`` that day of it; returns its row count.

    Only the catalog changes. A later rewrite of a folder shows in the table once it is refreshed.
    """
    _point(spark, table, spark.read.parquet(path).schema, path, location, by_day, day)
    return _count(spark, table, day)


def _count(spark: SparkSession, table: str, day: Day) -> int:
    spark.catalog.refreshTable(table)
    rows = spark.table(table)
    return (rows if day is None else one_day(rows, day)).count()


def _check(staged: DataFrame, table: str, checks: str) -> None:
    name = table.split(".")[-1].strip("`")
    if any(model == name for model, _, _ in declared_checks(checks)):
        failed = check_report({name: staged}, checks).filter("violations > 0").collect()
        if failed:
            raise CheckFailed(", ".join(f"{r.model}.{r.column} {r.test}: {r.violations}" for r in failed))


def _point(spark: SparkSession, table: str, schema: StructType, folder: str, location: str, by_day: bool, day: Day) -> None:
    """Point the catalog to the files of ``folder``; a table of other columns is made anew."""
    if by_day:
        schema = StructType([f for f in schema if f.name != DAY] + [schema[DAY]])
    live = spark.catalog.tableExists(table)
    if live and [(f.name, f.dataType) for f in spark.table(table).schema] != [(f.name, f.dataType) for f in schema]:
        if day is not None:
            raise ValueError(f"{table} has other columns: publish all of its days")
        spark.sql(f"DROP TABLE {table}")  # of an external table the files stay
        live = False
    if not live:
        parts = f"PARTITIONED BY ({DAY}) LOCATION '{location}'" if by_day else f"LOCATION '{folder}'"
        spark.sql(f"CREATE TABLE {table} ({schema.toDDL()}) USING parquet {parts}")
    elif not by_day:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    if by_day:
        _point_days(spark, table, folder, day)


def _point_days(spark: SparkSession, table: str, folder: str, day: Day) -> None:
    wanted = partition_values(spark, folder, DAY, null=True) if day is None else [run_date(day)]
    there = {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    part = {d: _part(d) for d in {*wanted, *there}}
    at = {d: f"LOCATION '{folder}/{DAY}={d}'" for d in wanted}
    if new := [f"{part[d]} {at[d]}" for d in wanted if d not in there]:
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(new)}")
    for d in wanted:
        if d in there:
            spark.sql(f"ALTER TABLE {table} {part[d]} SET {at[d]}")
    for d in there - {*wanted} if day is None else ():
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {part[d]}")


def _part(day: str) -> str:
    return f"PARTITION ({DAY} = NULL)" if day == NULL else f"PARTITION ({DAY} = DATE'{day}')"


def _location(spark: SparkSession, table: str, part: str = "") -> str:
    """Where the catalog says that the table, or a day of it, is."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table} {part}").collect()
    return next(r[1] for r in rows if r[0] == "Location")


def _retire(spark: SparkSession, table: str, location: str, by_day: bool) -> None:
    """Remove loads, or days of loads, but the newest ``KEPT`` and the live one."""
    loads = sorted(map(int, partition_values(spark, location, "load")), reverse=True)
    folders = {n: f"{location}/load={n}" for n in loads}
    if not by_day:
        for n in loads[KEPT:]:
            if not _location(spark, table).endswith(f"/load={n}"):
                remove(spark, folders[n])
        return
    days = {n: partition_values(spark, folders[n], DAY, null=True) for n in loads}
    there = {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for d in {d for own in days.values() for d in own}:
        old = [n for n in loads if d in days[n]][KEPT:]
        live = _location(spark, table, _part(d)) if old and d in there else ""
        for n in old:
            if not live.endswith(f"/load={n}/{DAY}={d}"):
                remove(spark, f"{folders[n]}/{DAY}={d}")
                days[n].remove(d)
    for n in loads[KEPT:]:
        if not days[n]:
            remove(spark, folders[n])


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | str],
    database: str,
    location: str,
    *,
    replace: bool = True,
    day: Day = None,
    checks: str = "",
    link: bool = False,
    parallel: int = 4,
) -> DataFrame:
    """Publish every table, given as rows or as a parquet path; one audit row per table.

    A table that fails is reported, keeps what it had, and the others go on. With a
    ``day``, daily tables that exist get that day only, and the audit counts its
    rows. ``checks`` hold staged rows back from the table that they name. With
    ``link``, tables given as a path are linked.
    """
    ensure_database(spark, database, location)

    def load(name: str, given: DataFrame | str) -> tuple:
        table, by_day = f"`{database}`.`{name}`", name in DAILY_TABLES
        try:
            own = day if by_day and spark.catalog.tableExists(table) else None
            where = {"location": f"{location}/{name}", "by_day": by_day, "day": own}
            if link and isinstance(given, str):
                count = link_table(spark, given, table, **where)
            else:
                rows = spark.read.parquet(given) if isinstance(given, str) else given
                count = publish_table(spark, rows, table, replace=replace or own is not None, checks=checks, **where)
            return name, "loaded", count, None
        except Exception as error:  # one bad table must not stop the rest
            return name, "failed", None, str(error)

    audit = at_once([partial(load, name, given) for name, given in tables.items()], parallel)
    return spark.createDataFrame(audit, AUDIT_DDL)
