"""Column helpers for text that cannot be trusted."""

from __future__ import annotations

import datetime as dt
import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: where a landed file's path states its day.
DAY_IN_PATH = r"snapshot_date=(\d{4}-\d{2}-\d{2})"

Day = str | dt.date | None


def run_date(day: Day = None) -> str:
    """The day of a run as text, today when none is given: the same one for all its steps."""
    return str(day or dt.date.today())


def day_literal(day: Day = None) -> Column:
    """The run's day as a date; today when none is given."""
    return F.current_date() if day is None else F.lit(str(day)).cast("date")


def day_from_path(path: Column) -> Column:
    """The day stated in a path, null when there is none (``to_date`` would raise)."""
    return F.try_to_date(F.regexp_extract(path, DAY_IN_PATH, 1), "yyyy-MM-dd")


def safe_date(text: Column) -> Column:
    """A date, or null for text that is not one."""
    return text.try_cast("date")


def parse_json(text: Column, ddl: str) -> Column:
    """JSON text as a struct of ``ddl``; a field of the wrong type becomes null.

    PERMISSIVE is the default mode. It is not spelled out because Catalyst only
    prunes the schema of a ``from_json`` that carries no options.
    """
    return F.from_json(text, ddl)


def any_present(columns: list[str]) -> Column:
    """True when one of the columns is not null."""
    return reduce(operator.or_, [F.col(c).isNotNull() for c in columns])


def all_present(columns: list[str]) -> Column:
    """True when none of the columns is null."""
    return reduce(operator.and_, [F.col(c).isNotNull() for c in columns])


def between_days(column: Column, first: Column, last: Column) -> Column:
    return column.between(first, last)


def lookback(column: Column, day: Day, days: int = 1) -> Column:
    """True within the ``days`` before ``day`` and on it."""
    end = day_literal(day)
    return column.between(F.date_sub(end, days), end)
