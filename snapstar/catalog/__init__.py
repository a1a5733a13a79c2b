"""Every operator and job as a query over the given tables, beside the SQL that states its result."""

from __future__ import annotations

from snapstar.catalog import changes, keyed, nested, publishing, silver, tracking, upkeep  # noqa: F401 (each registers its queries)
from snapstar.catalog.base import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
