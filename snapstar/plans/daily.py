"""One day from landed files to marts, in the order the steps depend on each other."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from snapstar.functions.columns import Day, run_date
from snapstar.operators.quality import check_report
from snapstar.plans.carry import carry, newest
from snapstar.plans.examples import first_example, second_example
from snapstar.plans.landing import land_files
from snapstar.plans.ledger import Ledger
from snapstar.plans.marts import ADVANCE, BRIDGES, DIMENSIONS, FACT, FACT_DDL, FACT_VIEW, advance_fact, build_staging, create_views
from snapstar.plans.models import levels, part, select
from snapstar.plans.parse import parse_landed
from snapstar.plans.silver import build_silver, read_silver
from snapstar.schemas import RAW_DDL, SILVER_TABLES, STAGING
from snapstar.session import remove, shuffles_removed
from snapstar.sinks.publish import AUDIT_DDL, publish
from snapstar.sinks.write import DAY, at_once, overwrite
from snapstar.sources.tables import one_day, read_table, source_tables


def build_marts(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    marts: str,
    *,
    day: Day = None,
    full_refresh: bool = False,
    choice: str | None = None,
) -> None:
    """Rewrite dimensions and bridges, and advance the fact; of these the ones of a ``choice`` (``models.select``).

    With a ``day``, the marts over all days go on from their last state, and the
    last state, which ``read_marts`` finds, is the table. Models are built level
    by level, those of a level at once.
    """
    views = build_staging(source_tables(tables), register=True)

    def write(name: str) -> None:
        view, build = (DIMENSIONS | BRIDGES)[name]
        if day is not None and name in ADVANCE:
            carry(spark, f"{marts}/{name}", day, views[view], build, ADVANCE[name])
        else:
            overwrite(build(views[view]), f"{marts}/{name}")

    def write_fact() -> None:
        advance_fact(spark, views[FACT_VIEW], f"{marts}/{FACT}", full_refresh=full_refresh)

    for level in levels(part(select(choice))):
        at_once([write_fact if name == FACT else partial(write, name) for name in level if name not in STAGING])


def read_marts(spark: SparkSession, marts: str) -> dict[str, DataFrame]:
    tables = {name: read_table(spark, newest(spark, f"{marts}/{name}")) for name in (*DIMENSIONS, *BRIDGES)}
    return tables | {FACT: read_table(spark, f"{marts}/{FACT}", FACT_DDL)}


def run_publish(
    spark: SparkSession, root: str, database: str, day: Day = None, *, checks: str = "", link: bool = False
) -> DataFrame:
    """Publish a day of the silver tables; returns the load audit, which is kept under ``root/audit``.

    With ``link`` the database gets no files of its own: its days are the silver folders.
    """
    silver = f"{root}/silver"
    read = (lambda name: newest(spark, f"{silver}/{name}")) if link else (lambda name: read_silver(spark, silver, name))
    tables = {name: read(name) for name in SILVER_TABLES}
    audit = publish(spark, tables, database, f"{root}/warehouse", day=run_date(day), checks=checks, link=link)
    overwrite(audit, f"{root}/audit/{DAY}={run_date(day)}")
    return read_table(spark, f"{root}/audit/{DAY}={run_date(day)}", AUDIT_DDL)


def run_marts(
    spark: SparkSession,
    root: str,
    database: str,
    day: Day = None,
    *,
    full_refresh: bool = False,
    choice: str | None = None,
) -> None:
    """Model the published tables as of a day, and keep the views in the database; ``full_refresh`` makes the fact anew."""
    create_views(spark, database, [view for view in STAGING if view in select(choice)])
    published = {name: spark.table(f"`{database}`.`{name}`") for name in SILVER_TABLES}
    build_marts(spark, published, f"{root}/marts", day=run_date(day), full_refresh=full_refresh, choice=choice)


def run_after_landing(
    spark: SparkSession,
    root: str,
    database: str,
    day: Day = None,
    *,
    mode: str = "replace_day",
    full_refresh: bool = False,
    checks: str = "",
    link: bool = False,
    resume: bool = False,
    attempts: int = 1,
    keep: bool = True,
) -> DataFrame:
    """Parse, flatten, publish and model a day that is landed; returns the load audit.

    With ``resume`` a run that failed goes on: steps that finished with what is
    there now are left out, up to the first one that has to run (``Ledger``). No
    shuffle stays on disk after the write that needs it. Without ``keep`` the day's
    documents go as soon as no later step reads them, landed and parsed: for days
    that run in order and once, since a late day or a rerun builds on them.
    """
    if resume and not keep:
        raise ValueError("a run that goes on needs its documents")
    day = run_date(day)
    steps = Ledger(spark, root, day, resume=resume, attempts=attempts)
    raw, parsed, silver = f"{root}/raw", f"{root}/parsed", f"{root}/silver"
    landed = one_day(read_table(spark, raw, RAW_DDL), day)
    with shuffles_removed(spark):
        steps.step("parse", lambda: parse_landed(landed, parsed, mode, day), f"{raw}/{DAY}={day}")
        if not keep:
            remove(spark, f"{raw}/{DAY}={day}")
        steps.step("silver", lambda: build_silver(spark, parsed, silver, day, mode, state_root=silver), parsed)
        if not keep:
            remove(spark, f"{parsed}/{DAY}={day}")
        steps.step("publish", lambda: run_publish(spark, root, database, day, checks=checks, link=link), silver)
        steps.step("marts", lambda: run_marts(spark, root, database, day, full_refresh=full_refresh), silver, f"{root}/audit")
    return read_table(spark, f"{root}/audit/{DAY}={day}", AUDIT_DDL)


def run_day(
    spark: SparkSession,
    files_root: str,
    root: str,
    database: str,
    day: Day = None,
    **options,
) -> DataFrame:
    """Land a day's files and bring everything up to date; returns the load audit.

    Without a day it is today's run. With ``replace_day`` a rerun leaves the
    same tables; ``append`` doubles the day in the daily tables. ``options`` are
    those of ``run_after_landing``.
    """
    day = run_date(day)
    land_files(spark, files_root, f"{root}/raw", day)
    return run_after_landing(spark, root, database, day, **options)


def run_checks(spark: SparkSession, database: str, marts: str) -> DataFrame:
    """The declared checks on the staging views, the marts and the two examples."""
    published = {name: spark.table(f"`{database}`.`{name}`") for name in SILVER_TABLES}
    models = build_staging(source_tables(published))
    models |= read_marts(spark, marts)
    first = first_example(spark)
    return check_report(models | {"first_example": first, "second_example": second_example(first)})
