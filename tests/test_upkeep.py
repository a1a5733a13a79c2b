"""States of keys, compaction and drift."""

import datetime as dt
import random

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from snapstar.operators.unique import all_duplicates, check_day
from snapstar.plans.drift import drift, with_rest
from snapstar.plans.parse import parse_documents, readable
from snapstar.sinks.compact import compact, small_days
from snapstar.sinks.write import append_days
from snapstar.sources.tables import read_table


def test_days_against_states(spark, root):
    """Each day's check equals one over all rows so far; reruns, null keys and a hot key included."""
    rand, history = random.Random(4), {}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS states LOCATION '{root}/db'")
    for d in (8, 9, 8, 10, 9):
        history[d] = [(rand.choice([1, 1, 1, None, rand.randint(2, 60)]), rand.choice(["a", None, "b"])) for _ in range(30)]
        rows = spark.createDataFrame(history[d], "k int, s string").repartition(3)
        found = check_day(spark, rows, ["k", "s"], f"2026-04-{d:02d}", "states.pairs", location=root, buckets=4)
        every = [r for own in history.values() for r in own if None not in r]
        counts = {r: every.count(r) for r in every if every.count(r) > 1}
        assert {(r.k, r.s): r.n_rows for r in found.collect()} == {r: n for r, n in counts.items() if r in history[d]}
        assert {(r.k, r.s): r.n_rows for r in all_duplicates(spark, ["k", "s"], "states.pairs").collect()} == counts
    assert "Exchange" not in plan_of(all_duplicates(spark, ["k", "s"], "states.pairs"))
    nothing = check_day(spark, rows.limit(0), ["k", "s"], "2026-04-11", "states.pairs", location=root)
    assert nothing.count() == 0 and nothing.columns == ["k", "s", "n_rows"]


def test_compaction(spark, root):
    rows = spark.range(3000).selectExpr("id", "cast(rand(1) as string) as text", "date'2026-04-08' + cast(id % 2 as int) as snapshot_date").cache()
    for i in range(4):
        append_days(rows.filter(f"id % 4 = {i}").repartition(5), root)
    before = rows_of(read_table(spark, root), "id", "text", "snapshot_date")
    found = compact(spark, root, full=20_000)
    assert [(r.snapshot_date, r.files) for r in found.collect()] == [(dt.date(2026, 4, d), 10) for d in (8, 9)]
    wanted = found.first().wanted
    assert 1 < wanted < 6
    files = read_table(spark, root).select("snapshot_date", "_metadata.file_path").distinct().groupBy("snapshot_date").count()
    assert {r["count"] for r in files.collect()} == {wanted}
    assert rows_of(read_table(spark, root), "id", "text", "snapshot_date") == before
    assert compact(spark, root).count() == 2 and small_days(spark, root).isEmpty() and compact(spark, root).count() == 0
    assert rows_of(read_table(spark, root), "id", "text", "snapshot_date") == before


TEXTS = [
    '{"id":1,"new":{"a":1},"genres":[{"id":"x","odd \'f":2}],"budget":"much","title":5}',
    '{"id":2.5,"genres":[{"id":3},null],"budget":4,"adult":"yes"}',
    '{"id":7,"genres":{"id":3},"credits":[],"belongs_to_collection":{"id":1}}',
    "nope",
    "[1]",
    '{"id":null,"new":null,"credits":{"cast":[{"id":1},{"nick":"n"}]}}',
]


@pytest.mark.parametrize("texts", [TEXTS, TEXTS[3:5], []])
def test_drift(spark, texts):
    raw = spark.createDataFrame([(t, "f", None) for t in texts], "raw_json string, source_file string, snapshot_date date")
    found = {(r.path, r.kind): r.documents for r in drift(raw).collect()}
    assert found == ({} if len(texts) < 6 else {
        ("id", "retyped"): 1, ("new", "unknown"): 2, ("genres", "retyped"): 1, ("budget", "retyped"): 1, ("adult", "retyped"): 1, ("credits", "retyped"): 1,
    })
    kept = with_rest(raw, readable(parse_documents(raw)))
    news = kept.filter("id = 1").select(F.try_variant_get("document", "$.new.a", "int").alias("a")).collect()
    assert [r.a for r in news] == ([1] if len(texts) == 6 else [])


def test_drift_within_arrays(spark):
    raw = spark.createDataFrame([(TEXTS[0],), (TEXTS[1],), (TEXTS[5],)], "raw_json string")
    found = {(r.path, r.kind, r.declared): r.documents for r in drift(raw).collect()}
    assert found["genres[*].odd 'f", "unknown", None] == 1 and found["genres[*].id", "retyped", "bigint"] == 1
    assert found["credits.cast[*].nick", "unknown", None] == 1
