"""Staging, marts, the fact, landing and states that are carried on."""

import datetime as dt
from pathlib import Path

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from snapstar.plans import marts
from snapstar.plans.carry import carry
from snapstar.plans.landing import absent_files, land, land_files
from snapstar.session import scratch, workspace
from snapstar.session import stored as kept_aside
from snapstar.sources.raw import read_raw_files, slice_of
from snapstar.plans.marts import FACT_DDL, advance_fact, merge_days
from snapstar.schemas import RAW_DDL, STAGING, names
from snapstar.sinks.write import replace_day
from snapstar.sources.tables import partition_values, read_table

FACT = "movie_id bigint, snapshot_date string, popularity double"


def fact(spark, *rows):
    data = spark.createDataFrame(rows, FACT).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    return data.selectExpr(
        "movie_id", "snapshot_date", "popularity", "0D as vote_average", "0L as vote_count", "0L as revenue",
        "0L as runtime", "'s' as status",
    )


def stored(spark, root):
    rows = read_table(spark, root, FACT_DDL).selectExpr("movie_id", "day(snapshot_date) as d", "popularity")
    return rows_of(rows)


def test_fact_first_run_takes_all_days(spark, root):
    advance_fact(spark, fact(spark, (1, "2020-01-05", 1.0), (1, "2026-04-08", 2.0)), root)
    assert stored(spark, root) == [(1, 5, 1.0), (1, 8, 2.0)]


def test_fact_next_days_and_late_ones(spark, root):
    advance_fact(spark, fact(spark, (1, "2026-04-08", 1.0)), root)
    both = fact(spark, (1, "2026-04-08", 9.0), (1, "2026-04-09", 3.0), (1, "2026-04-09", 2.0), (2, "2026-04-07", 5.0))
    for _ in range(2):
        advance_fact(spark, both, root)
    assert stored(spark, root) == [(1, 8, 1.0), (1, 9, 2.0)]


def test_fact_may_keep_duplicates(spark, root):
    advance_fact(spark, fact(spark, (1, "2026-04-08", 1.0)), root)
    advance_fact(spark, fact(spark, (1, "2026-04-09", 3.0), (1, "2026-04-09", 2.0)), root, keep_duplicates=True)
    assert stored(spark, root) == [(1, 8, 1.0), (1, 9, 2.0), (1, 9, 3.0)]


def test_fact_empty_target_and_refresh(spark, root):
    advance_fact(spark, fact(spark), root)
    advance_fact(spark, fact(spark, (1, "2025-04-09", 1.0), (1, "2026-04-08", 2.0)), root)
    assert stored(spark, root) == [(1, 8, 2.0)]
    advance_fact(spark, fact(spark, (3, "2025-04-09", 1.0)), root, full_refresh=True)
    assert stored(spark, root) == [(3, 9, 1.0)]


def test_merge_rewrites_touched_days_only(spark, root):
    merge_days(spark, fact(spark, (1, "2026-04-08", 1.0), (2, "2026-04-08", 1.0), (1, "2026-04-09", 1.0)), root, FACT_DDL)
    before = {f for f in read_table(spark, root).inputFiles() if "2026-04-09" in f}
    delta = fact(spark, (1, "2026-04-08", 5.0), (1, "2026-04-08", 4.0), (3, "2026-04-08", 3.0), (4, "2026-04-07", 2.0))
    merge_days(spark, delta, root, FACT_DDL)
    assert stored(spark, root) == [(1, 8, 4.0), (1, 9, 1.0), (2, 8, 1.0), (3, 8, 3.0), (4, 7, 2.0)]
    assert before == {f for f in read_table(spark, root).inputFiles() if "2026-04-09" in f}


def raw(spark, *rows):
    data = [(i, text, f"f{i}", dt.date.fromisoformat(day)) for i, text, day in rows]
    return spark.createDataFrame(data, RAW_DDL)


def test_landing(spark, root):
    assert land(spark, raw(spark, (1, "a", "2026-04-08"), (1, "b", "2026-04-08"), (2, "c", "2026-04-08")), root) == 2
    again = raw(spark, (1, "z", "2026-04-08"), (3, "d", "2026-04-08"), (1, "e", "2026-04-09"))
    assert land(spark, again, root) == 2
    assert rows_of(read_table(spark, root, RAW_DDL), "movie_id", "raw_json") == [(1, "a"), (1, "e"), (2, "c"), (3, "d")]
    land(spark, again, root, replace=True)
    assert rows_of(read_table(spark, root, RAW_DDL), "movie_id", "raw_json") == [(1, "e"), (1, "z"), (2, "c"), (3, "d")]


def test_landing_files(spark, tmp_path):
    folder = tmp_path / "files" / "snapshot_date=2026-04-08"
    folder.mkdir(parents=True)
    given = f"{tmp_path}/files", f"{tmp_path}/raw", "2026-04-08"
    (folder / "movie_id=7.json").write_text('{"id": 7}')
    assert [land_files(spark, *given) for _ in range(2)] == [1, 0]
    for name in ("x1", "x2", "a b%20c"):
        (folder / f"movie_id={name}.json").write_text(f'{{"id": "{name}"}}')
    (folder / "other.json").write_text("{}")
    assert [land_files(spark, *given) for _ in range(2)] == [3, 0]
    expected = [(None, '{"id": "a b%20c"}'), (None, '{"id": "x1"}'), (None, '{"id": "x2"}'), (7, '{"id": 7}')]
    assert rows_of(read_table(spark, f"{tmp_path}/raw", RAW_DDL), "movie_id", "raw_json") == expected
    (folder / "movie_id=x1.json").write_text('{"id": 1}')
    assert land_files(spark, *given, replace=True) == 4
    expected[1] = (None, '{"id": "x2"}')
    expected[2] = (None, '{"id": 1}')
    assert rows_of(read_table(spark, f"{tmp_path}/raw", RAW_DDL), "movie_id", "raw_json") == sorted(
        expected, key=lambda r: (r[0] is not None, r[1])
    )
    (folder / "movie_id=x2.json").unlink()
    land(spark, raw(spark, (None, "no path", "2026-04-08")).withColumn("source_file", F.lit(None).cast("string")), given[1], day=given[2])
    assert land_files(spark, *given, replace=True) == 3
    found = rows_of(read_table(spark, f"{tmp_path}/raw", RAW_DDL), "movie_id", "raw_json")
    assert found == sorted([*expected, (None, "no path")], key=lambda r: (r[0] is not None, r[1]))
    assert "raw_json" not in plan_of(absent_files(spark, *given))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        land_files(spark, f"{tmp_path}/files", f"{tmp_path}/raw", "2026-04-09")


def opened(df):
    """How many files a scan has opened, once it ran."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.getClass().getSimpleName() else plan
    return plan.collectLeaves().apply(0).metrics().apply("numFiles").value()


def test_only_new_files_are_opened(spark, tmp_path):
    """The next run opens the files that share a slice with a new one, and keeps nothing in the scratch folder."""
    folder = tmp_path / "files" / "snapshot_date=2026-04-08"
    folder.mkdir(parents=True)
    for i in range(400):
        (folder / f"movie_id={i}.json").write_text(f'{{"id": {i}}}')
    given = f"{tmp_path}/files", f"{tmp_path}/raw", "2026-04-08"
    assert land_files(spark, *given) == 400
    assert len(list((tmp_path / "raw").rglob("part-*.parquet"))) <= spark.sparkContext.defaultParallelism
    (folder / "movie_id=1000.json").write_text("{}")
    (folder / "movie_id=1001.json").write_text("{}")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = sorted(shared.iterdir())
    slices = [r[0] for r in absent_files(spark, *given).select(slice_of("source_file")).collect()]
    files = read_raw_files(spark, given[0], given[2], slices)
    assert len(files.collect()) == opened(files) < 20
    assert land_files(spark, *given) == 2 and land_files(spark, *given) == 0
    assert read_table(spark, given[1], RAW_DDL).count() == 402
    assert sorted(shared.iterdir()) == before


def test_workspace(spark):
    df = spark.range(3)
    outer = scratch(spark, "outer")
    with pytest.raises(ValueError), workspace(spark):
        kept_aside(df, "one")
        with workspace(spark):
            inner = kept_aside(df, "two").inputFiles()[0]
        assert not Path(inner.removeprefix("file://")).exists()
        found = kept_aside(df, "three").inputFiles()[0]
        assert Path(found.removeprefix("file://")).exists()
        df.write.parquet(outer)
        raise ValueError
    assert not Path(found.removeprefix("file://")).exists() and spark.read.parquet(outer).count() == 3
    assert kept_aside(df, "four").count() == 3


CREDIT = "movie_id bigint, person_id bigint, character string, cast_order bigint, credit_id string, day int"


def credits(spark, *rows):
    df = spark.createDataFrame(rows, CREDIT)
    return df.withColumn("snapshot_date", F.make_date(F.lit(2026), F.lit(4), "day")).drop("day")


DAY_ONE = [(1, 1, "old", 0, "a", 8), (1, 2, "gone", 1, "b", 8), (1, 1, "x", 2, None, 8), (None, 1, "n", 3, "c", 8)]
DAY_TWO = [(1, 1, "new", 0, "a", 9), (1, 1, "y", 2, None, 9), (1, 3, "B", 3, "d", 9), (1, 3, "A", 3, "d", 9)]


def test_bridge_keeps_the_last_version(spark):
    found = rows_of(marts.cast_bridge(credits(spark, *DAY_ONE, *DAY_TWO)), "person_id", "character")
    assert found == [(1, "new"), (1, "y"), (2, "gone"), (3, "A")]


def test_carry(spark, root):
    history = credits(spark, *DAY_ONE, *DAY_TWO)
    steps = marts.cast_bridge, marts.advance_cast_bridge
    full = rows_of(marts.cast_bridge(history))
    first = carry(spark, root, "2026-04-08", history.filter("day(snapshot_date) = 8"), *steps)
    assert first.count() == 3
    for _ in range(2):
        assert rows_of(carry(spark, root, "2026-04-09", history, *steps)) == full
    # A day without rows changes nothing; a late day has the last state rebuilt.
    assert rows_of(carry(spark, root, "2026-04-10", history, *steps)) == full
    late = credits(spark, *DAY_ONE, *DAY_TWO, (5, 5, "late", 0, "z", 7))
    assert rows_of(carry(spark, root, "2026-04-07", late, *steps)) == rows_of(marts.cast_bridge(late))
    assert partition_values(spark, root, "generation") == ["2"]
    # A rerun of the last day and the days after it keep the late one.
    for day in ("2026-04-10", "2026-04-11", "2026-04-12", "2026-04-13", "2026-04-14"):
        assert rows_of(carry(spark, root, day, late, *steps)) == rows_of(marts.cast_bridge(late))
    assert len(partition_values(spark, root + "/generation=2", "as_of")) == 3


def test_replace_day_with_nothing(spark, root):
    both = fact(spark, (1, "2026-04-08", 1.0), (1, "2026-04-09", 2.0))
    for day in ("2026-04-08", "2026-04-09"):
        replace_day(both, root, day)
    assert stored(spark, root) == [(1, 8, 1.0), (1, 9, 2.0)]
    replace_day(both.filter("popularity > 1"), root, "2026-04-08")
    assert stored(spark, root) == [(1, 9, 2.0)]


def test_a_skipped_day_is_caught_up(spark, root):
    steps = marts.cast_bridge, marts.advance_cast_bridge
    carry(spark, root, "2026-04-07", credits(spark, (9, 9, "c", 0, "q", 7)), *steps)
    history = credits(spark, (9, 9, "c", 0, "q", 7), *DAY_ONE, *DAY_TWO)
    assert rows_of(carry(spark, root, "2026-04-09", history, *steps)) == rows_of(marts.cast_bridge(history))


@pytest.fixture
def root(tmp_path):
    return f"{tmp_path}/t"


@pytest.mark.parametrize("view", STAGING)
def test_staging_types(spark, view):
    source, columns = STAGING[view]
    text = spark.range(1).select(*[F.lit("1").alias(c.split()[0]) for c in names(columns)])
    dates = [c.split()[0] for c in names(columns) if c.endswith(" date")]
    text = text.withColumns({c: F.lit("2026-04-08") for c in dates})
    staged = marts.staging({source: text}, view)
    expected = [(c.split()[0], (c.split() + ["string"])[1]) for c in names(columns)]
    assert staged.dtypes == expected
    assert staged.count() == 1


def test_staging_drops_rows_without_their_key(spark):
    rows = spark.createDataFrame([(None, "x"), (1, "y")], "genre_id int, genre_name string")
    assert rows_of(marts.staging({"dim_genre": rows}, "stg_dim_genre")) == [(1, "y")]


def test_strict_casts_raise(spark):
    rows = spark.createDataFrame([("x", "y")], "genre_id string, genre_name string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        marts.staging({"dim_genre": rows}, "stg_dim_genre").collect()
