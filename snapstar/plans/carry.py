"""Tables over all days, carried on from their last state instead of rebuilt from history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.functions.columns import Day
from snapstar.sinks.write import DAY, overwrite
from snapstar.sources.tables import partition_values, remove

Build = Callable[[DataFrame], DataFrame]
Advance = Callable[[DataFrame, DataFrame], DataFrame]

#: States that stay: a rerun of the last day needs the one before it.
KEPT = 3


def newest(spark: SparkSession, path: str) -> str:
    """The folder of the last state under ``path``, or ``path`` itself for a table without states."""
    generations = [int(g) for g in partition_values(spark, path, "generation")]
    if not generations:
        return path
    folder = f"{path}/generation={max(generations)}"
    return f"{folder}/as_of={max(partition_values(spark, folder, 'as_of'))}"


def carry(
    spark: SparkSession, path: str, day: Day, history: DataFrame, build: Build, advance: Advance
) -> DataFrame:
    """The table as of its last day, kept in ``path/generation=N/as_of=D``.

    It goes on from the last state before ``day`` with the rows of all days
    since, so a rerun of the day gives the same, and a day that was skipped is
    caught up. A day before the last state changes what follows it: then a new
    generation starts, built from all of ``history``, and no state of an older
    one is used again. Without a state to go on from, a generation is likewise
    built from history. States are found by listing folders, and the last
    ``KEPT`` of the newest generation stay.
    """
    generations = sorted(int(g) for g in partition_values(spark, path, "generation"))
    generation = generations[-1] if generations else 1
    states = partition_values(spark, f"{path}/generation={generation}", "as_of")
    last, earlier = max(states, default=str(day)), [s for s in states if s < str(day)]
    if str(day) < last:
        generation, states, rows, as_of = generation + 1, [], build(history), last
    elif earlier:
        since = history.filter(F.col(DAY) > F.lit(earlier[-1]).cast("date"))
        base = spark.read.parquet(f"{path}/generation={generation}/as_of={earlier[-1]}")
        rows, as_of = advance(base, since), str(day)
    else:
        rows, as_of = build(history), str(day)
    target = f"{path}/generation={generation}/as_of={as_of}"
    overwrite(rows, target)
    for old in generations:
        if old < generation:
            remove(spark, f"{path}/generation={old}")
    for state in sorted({*states, as_of})[:-KEPT]:
        remove(spark, f"{path}/generation={generation}/as_of={state}")
    return spark.read.parquet(target)
