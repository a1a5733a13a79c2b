"""Keyed operators against plain Python, and with keys that hold most of the rows."""

import pytest
from conftest import plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapstar.functions.columns import all_present, any_present
from snapstar.operators.incremental import newer_rows, rows_of_same_days
from snapstar.operators.keyed import (
    dimension,
    insert_absent,
    one_per_key,
    set_difference,
    set_union,
    supersede,
    upsert,
)

QUICK = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
key = st.one_of(st.none(), st.integers(0, 3))
pairs = st.lists(st.tuples(key, st.integers(0, 5)), max_size=12)


def frame(spark, data, ddl="k int, v int"):
    return spark.createDataFrame(data, ddl)


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])


@QUICK
@given(pairs)
def test_one_per_key(spark, data):
    best = {}
    for k, v in data:
        best[k] = min(best.get(k, v), v)
    assert rows_of(one_per_key(frame(spark, data), ["k"])) == ordered(best.items())


@QUICK
@given(pairs, pairs)
def test_upsert(spark, target, delta):
    fresh = {}
    for k, v in delta:
        fresh[k] = min(fresh.get(k, v), v)
    # A null key matches nothing, so its target rows stay beside the new one.
    kept = [(k, v) for k, v in target if k is None or k not in fresh]
    found = upsert(frame(spark, target), frame(spark, delta), ["k"])
    assert rows_of(found) == ordered(kept + list(fresh.items()))


@QUICK
@given(pairs, pairs)
def test_insert_absent(spark, target, delta):
    there = {k for k, _ in target if k is not None}
    best = {}
    for k, v in delta:
        best[k] = min(best.get(k, v), v)
    expected = [(k, v) for k, v in best.items() if k is None or k not in there]
    assert rows_of(insert_absent(frame(spark, target), frame(spark, delta), ["k"])) == ordered(expected)


@QUICK
@given(pairs, pairs)
def test_supersede(spark, before, after):
    old, new = dict(before), dict(after)
    later = frame(spark, list(new.items())).withColumn("snapshot_date", F.lit("2026-04-08").cast("date"))
    found = supersede(frame(spark, list(old.items())), later, ["k"])
    assert rows_of(found) == ordered((old | new).items())


@QUICK
@given(st.lists(st.integers(0, 6)), st.lists(st.integers(0, 6)))
def test_sets(spark, left, right):
    a, b = (frame(spark, [(v,) for v in ids], "movie_id int") for ids in (left, right))
    assert rows_of(set_difference(a, b)) == [(v,) for v in sorted(set(left) - set(right))]
    assert rows_of(set_union(a, b)) == [(v,) for v in sorted(set(left) | set(right))]


def skewed(spark, n=30000):
    """Two thirds of the rows have key 0, half of those are equal copies."""
    return spark.range(0, n, 1, 8).selectExpr(
        "cast(if(id % 3 = 0, id, 0) as int) as k", "cast(if(id % 6 = 1, 7, id) as int) as v"
    )


def test_hot_key_sends_one_row_per_task(spark):
    plan = plan_of(one_per_key(skewed(spark), ["k"]))
    below = plan[plan.index("Exchange") :]
    assert "Partial" in below and "WindowGroupLimit" in below
    assert one_per_key(skewed(spark), ["k"]).count() == 10000


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_hot_key_survives_or_goes_whole(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
    try:
        rows = skewed(spark)
        hot = rows.filter("k = 0").count()
        merged = upsert(rows, frame(spark, [(0, 1), (0, 0), (-1, 5)]), ["k"])
        assert merged.filter("k <= 0").count() == 2
        assert merged.count() == 30000 - hot + 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_merges_need_one_exchange(spark):
    rows = skewed(spark).withColumn("snapshot_date", F.lit("2026-04-08").cast("date"))
    once = rows.dropDuplicates(["k"])
    before = plan_of(once).count("Exchange hashpartitioning")
    both = upsert(rows, frame(spark, [(0, 1)]).withColumn("snapshot_date", F.lit("2026-04-08").cast("date")), ["k"])
    assert plan_of(both).count("Exchange hashpartitioning") == 1
    assert plan_of(supersede(once.drop("snapshot_date"), rows, ["k"])).count("Exchange hashpartitioning") == before + 1
    assert "Join" not in plan_of(both)


def test_dimension_shuffles_distinct_rows_only(spark):
    rows = skewed(spark).withColumn("snapshot_date", F.lit("2026-04-08").cast("date"))
    plan = plan_of(dimension(rows, ["k", "v"]))
    assert plan.count("partial_max") == 1


def test_presence(spark):
    rows = frame(spark, [(None, None), (1, None), (1, 2)])
    assert rows.filter(any_present(["k", "v"])).count() == 2
    assert rows.filter(all_present(["k", "v"])).count() == 1


def days(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "d string").selectExpr("cast(d as date) as snapshot_date")


def test_newer_rows(spark):
    delta = days(spark, "2025-04-09", "2026-04-08", "2026-04-09")
    assert newer_rows(delta, days(spark)).count() == 2
    assert newer_rows(delta, days(spark, "2026-04-08")).count() == 1
    assert newer_rows(delta, days(spark, "2026-04-09", "2026-01-01")).count() == 0


def test_marks_and_days_prune_partitions(spark, root):
    days(spark, "2026-04-08", "2026-04-09", "2026-04-10").withColumn("v", F.lit(1)).write.partitionBy(
        "snapshot_date"
    ).parquet(root + "/t")
    table = spark.read.parquet(root + "/t")
    newer = newer_rows(table, days(spark, "2026-04-08"))
    same = rows_of_same_days(table, days(spark, "2026-04-09", "2026-04-09", "2030-01-01"))
    assert newer.count() == 2 and same.count() == 1
    for df in (newer, same):
        filters = plan_of(df).split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "ubquery" in filters
