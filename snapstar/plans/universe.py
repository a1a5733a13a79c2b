"""The universe of tracked films, which only grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.functions.columns import Day
from snapstar.operators.keyed import set_difference, set_union
from snapstar.schemas import RAW_DDL
from snapstar.sources.discovery import discovered_ids, listed, missing_pages, read_pages, released_between
from snapstar.session import stored, workspace
from snapstar.sources.state import add_ids, known_ids, load_ids
from snapstar.sources.tables import one_day, read_or_empty


METRICS_DDL = "existing bigint, discovered bigint, truly_new bigint, succeeded bigint, failed bigint, universe_size bigint"


class IncompleteListing(ValueError):
    """A landed listing has fewer pages than it says."""


def new_ids(discovered: DataFrame, tracked: DataFrame) -> DataFrame:
    """Discovered ids that were not tracked."""
    return set_difference(discovered.select("movie_id"), tracked.select("movie_id"))


def updated_universe(tracked: DataFrame, discovered: DataFrame) -> DataFrame:
    return set_union(tracked.select("movie_id"), discovered.select("movie_id"))


def run_metrics(tracked: DataFrame, discovered: DataFrame, landed: DataFrame) -> DataFrame:
    """One row about a run: ids known before, found, new, landed or missing today, and in all.

    The three sets are tagged and grouped by id, so one shuffle answers all six.
    """
    tagged = [
        ids.select("movie_id", *[F.lit(tag == t).alias(t) for t in ("tracked", "found", "landed")])
        for tag, ids in (("tracked", tracked), ("found", discovered), ("landed", landed))
    ]
    by_id = tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).groupBy("movie_id")
    ids = by_id.agg(*[F.max(t).alias(t) for t in ("tracked", "found", "landed")])
    in_universe = F.col("tracked") | F.col("found")
    return ids.agg(
        F.count_if("tracked").alias("existing"),
        F.count_if("found").alias("discovered"),
        F.count_if(F.col("found") & ~F.col("tracked")).alias("truly_new"),
        F.count_if(in_universe & F.col("landed")).alias("succeeded"),
        F.count_if(in_universe & ~F.col("landed")).alias("failed"),
        F.count_if(in_universe).alias("universe_size"),
    )


def update_universe(
    spark: SparkSession,
    pages_root: str,
    state_path: str,
    day: Day,
    *,
    window: tuple[str, str] | None = None,
    landed_path: str | None = None,
) -> DataFrame:
    """Add the ids discovered on a day to the tracked ones; returns the run's metrics.

    A daily run looks for films released on the day itself. ``window`` looks for
    a range of release days instead, in the pages landed for that range. A
    listing that lacks pages raises ``IncompleteListing``, and nothing is saved.
    """
    first, last = window or (str(day), str(day))
    pages = read_pages(spark, pages_root, day, window)
    if lacking := missing_pages(pages).head(5):
        raise IncompleteListing(", ".join(f"{r.folder}: {r.landed} of {r.total_pages} pages" for r in lacking))
    landed = read_or_empty(spark, landed_path, RAW_DDL) if landed_path else spark.createDataFrame([], RAW_DDL)
    with workspace(spark):
        entries = listed(pages)
        discovered = stored(discovered_ids(released_between(entries, first, last)), "discovered")
        today = stored(one_day(landed, day).select("movie_id").distinct(), "landed-ids")
        return track(spark, state_path, discovered, today)


def track(spark: SparkSession, state_path: str, discovered: DataFrame, landed: DataFrame) -> DataFrame:
    """Add the discovered ids to the log of tracked ones; the metrics of ``run_metrics``, from the day's ids alone.

    Both tables have each id once. Of the tracked ids only those are looked at
    that may be among the day's; how many there are is in the footers of their files.
    """
    before = load_ids(spark, state_path)
    known = stored(known_ids(before, discovered), "known-ids")
    new = stored(set_difference(discovered.select("movie_id"), known), "new-ids")
    existing, found, truly_new = before.count(), discovered.count(), new.count()
    succeeded = set_union(known_ids(before, landed), landed.join(discovered, "movie_id", "left_semi")).count()
    if truly_new:
        add_ids(spark, new, state_path)
    universe = existing + truly_new
    return spark.createDataFrame([(existing, found, truly_new, succeeded, universe - succeeded, universe)], METRICS_DDL)


def backfill(
    spark: SparkSession,
    pages_root: str,
    state_path: str,
    first: str,
    last: str,
    day: Day,
    landed_path: str | None = None,
) -> DataFrame:
    """Add everything released from ``first`` to ``last``, as seen on ``day``."""
    return update_universe(spark, pages_root, state_path, day, window=(first, last), landed_path=landed_path)
