"""Loads that are staged, linked tables, views of the database, the order of models, and steps that are finished."""

import datetime as dt
from pathlib import Path

import pytest
from conftest import rows_of

from snapstar.plans import daily
from snapstar.plans.daily import run_after_landing
from snapstar.plans.ledger import Ledger, fingerprint
from snapstar.plans.marts import create_views, staging
from snapstar.plans.models import MODELS, Cycle, below, levels, part, select
from snapstar.schemas import RAW_DDL, SILVER_TABLES, SOURCES, STAGING
from snapstar.sinks.publish import publish
from snapstar.sinks.write import append, append_days, replace_days
from snapstar.sources.tables import partition_values

DAYS = "id int, snapshot_date date"


def days(spark, *rows):
    return spark.createDataFrame([(i, d and dt.date(2026, 4, d)) for i, d in rows], DAYS)


def files(path):
    return sorted(str(p) for p in Path(path).rglob("part-*.parquet"))


def test_failed_loads_leave_the_table(spark, root):
    given = days(spark, (1, 8), (2, 9), (3, None))
    checks = "movies id not_null unique"
    for rows, status in ((given, "loaded"), (days(spark, (1, 8), (1, 9)), "failed"), (given.selectExpr("id / (id - 2) as id", "snapshot_date"), "failed")):
        assert publish(spark, {"movies": rows}, "staged", root, checks=checks).first().status == status
        assert rows_of(spark.table("staged.movies")) == rows_of(given)
    assert partition_values(spark, f"{root}/movies", "load") == ["1"]
    # One day at a time; only rows of that day are checked.
    later = days(spark, (5, 9), (5, 8), (5, 8))
    assert publish(spark, {"movies": later}, "staged", root, checks=checks, day="2026-04-09").first().num_rows == 1
    assert publish(spark, {"movies": later}, "staged", root, checks=checks, day="2026-04-08").first().error == "movies.id unique: 1"
    assert rows_of(spark.table("staged.movies"), "id") == [(1,), (3,), (5,)]


def test_old_loads_go(spark, root):
    for i in range(5):
        publish(spark, {"movies": days(spark, (i, 8), (i, 9)), "other": days(spark, (i, 8))}, "kept", root)
    publish(spark, {"movies": days(spark, (9, 8))}, "kept", root, day="2026-04-08")
    assert partition_values(spark, f"{root}/movies", "load") == ["4", "5", "6"] and partition_values(spark, f"{root}/other", "load") == ["4", "5"]
    assert [partition_values(spark, f"{root}/movies/load={n}", "snapshot_date") for n in (4, 5, 6)] == [["2026-04-09"], ["2026-04-08", "2026-04-09"], ["2026-04-08"]]
    assert rows_of(spark.table("kept.movies"), "id") == [(4,), (9,)] and rows_of(spark.table("kept.other"), "id") == [(4,)]
    # A day that is gone is gone from the table; other columns make it anew.
    publish(spark, {"movies": days(spark, (1, 9))}, "kept", root)
    assert rows_of(spark.table("kept.movies"), "id") == [(1,)]
    publish(spark, {"movies": days(spark, (1, 9)).selectExpr("id as number", "snapshot_date")}, "kept", root)
    assert spark.table("kept.movies").columns == ["number", "snapshot_date"]


def test_linked_tables_write_no_file(spark, root):
    replace_days(days(spark, (1, 8), (2, 9)), f"{root}/silver/movies")
    append(days(spark, (7, 8)), f"{root}/silver/dim")
    for day in (None, "2026-04-08"):
        audit = publish(spark, {"movies": f"{root}/silver/movies", "dim": f"{root}/silver/dim"}, "linked", f"{root}/db", day=day, link=True)
        assert rows_of(audit, "table_name", "num_rows") == [("dim", 1), ("movies", 2 if day is None else 1)]
    before = files(f"{root}/silver")
    replace_days(days(spark, (3, 10)), f"{root}/silver/movies")
    publish(spark, {"movies": f"{root}/silver/movies"}, "linked", f"{root}/db", day="2026-04-10", link=True)
    assert files(f"{root}/db") == [] and set(before) < set(files(f"{root}/silver"))
    assert rows_of(spark.table("linked.movies"), "id") == [(1,), (2,), (3,)]
    # From links to loads: what was linked is not touched.
    publish(spark, {"movies": days(spark, (4, 10))}, "linked", f"{root}/db", day="2026-04-10")
    assert rows_of(spark.table("linked.movies"), "id") == [(1,), (2,), (4,)]
    publish(spark, {"movies": days(spark, (4, 10))}, "linked", f"{root}/db")
    assert len(files(f"{root}/silver/movies")) == 3


def test_views_equal_the_models(spark, root):
    from snapstar.catalog.shapes import films
    from snapstar.plans.silver import silver_table

    documents = films(spark, "/root/testdata/sf0.001")
    publish(spark, {t: silver_table(documents, t) for t in SOURCES}, "viewed", root)
    create_views(spark, "viewed")
    tables, other = {t: spark.table(f"viewed.{t}") for t in SOURCES}, spark.newSession()
    for view in STAGING:
        found, expected = other.table(f"viewed.{view}"), staging(tables, view)
        assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in expected.schema]
        assert rows_of(found) == rows_of(expected)


# --- models ------------------------------------------------------------------------------
def test_choice_of_models():
    assert select(None) == {*MODELS} and select("dim_movie") == {"dim_movie"}
    assert select("+dim_movie") == {"dim_movie", "stg_movies"} and select("stg_movies+") == {"dim_movie", "stg_movies"}
    chain = {"a": (), "b": ("a",), "c": ("b",), "d": ("a",), "e": ("c", "d")}
    assert select("+c+", chain) == {"a", "b", "c", "e"} and select("b+ d", chain) == {"b", "c", "d", "e"}
    assert below(chain, "e") == {*chain} and levels(chain) == [["a"], ["b", "d"], ["c"], ["e"]]
    assert levels(part({"b", "e"}, chain)) == [["b", "e"]]
    for bad in ({"a": ("b",), "b": ("c",), "c": ("b",)}, {"a": ("a",)}):
        with pytest.raises(Cycle):
            levels(bad)
    for choice in ("dim_film", "+nothing"):
        with pytest.raises(ValueError, match="no such model"):
            select(choice)
    with pytest.raises(ValueError, match="no such model: x"):
        levels({"a": ("x",)})


# --- steps -------------------------------------------------------------------------------
def test_ledger(spark, root):
    ran = []

    def run(resume, fails=None, attempts=1):
        steps = Ledger(spark, root, "2026-04-08", resume=resume, attempts=attempts)
        for name in "abc":
            def job(name=name):
                ran.append(name)
                if name == fails:
                    raise ValueError(name)

            steps.step(name, job, f"{root}/in")

    append(days(spark, (1, 8)), f"{root}/in")
    with pytest.raises(ValueError):
        run(False, "b", attempts=2)
    assert "".join(ran) == "abb"
    run(True)
    run(True)
    assert "".join(ran) == "abb" + "bc"
    append(days(spark, (2, 8)), f"{root}/in")
    run(True)
    run(False)
    assert "".join(ran) == "abbbc" + "abc" + "abc"
    assert fingerprint(spark, f"{root}/none") == "none" != fingerprint(spark, f"{root}/in")


def test_a_broken_run_goes_on(spark, root, monkeypatch):
    """A run broken after silver repeats neither parse nor silver; new documents have all repeated."""
    ran = []
    for name in ("parse_landed", "build_silver", "run_publish", "run_marts"):
        def noted(*given, _name=name, _call=getattr(daily, name), **options):
            ran.append(_name)
            if _name == "run_publish" and ran.count(_name) == 1:
                raise ConnectionError
            return _call(*given, **options)

        monkeypatch.setattr(daily, name, noted)
    raw = spark.createDataFrame([(1, '{"id": 1, "title": "a"}', "f1", dt.date(2026, 4, 8))], RAW_DDL)
    append_days(raw, f"{root}/raw")
    with pytest.raises(ConnectionError):
        run_after_landing(spark, root, "resumed", "2026-04-08")
    audit = run_after_landing(spark, root, "resumed", "2026-04-08", resume=True)
    assert ran == ["parse_landed", "build_silver", "run_publish", "run_publish", "run_marts"]
    assert audit.count() == len(SILVER_TABLES) and audit.filter("status = 'loaded'").count() == len(SILVER_TABLES)
    assert run_after_landing(spark, root, "resumed", "2026-04-08", resume=True).count() == len(SILVER_TABLES) and len(ran) == 5
    append_days(raw.selectExpr("2L as movie_id", "replace(raw_json, '1', '2') as raw_json", "'f2' as source_file", "snapshot_date"), f"{root}/raw")
    run_after_landing(spark, root, "resumed", "2026-04-08", resume=True)
    assert ran[5:] == ["parse_landed", "build_silver", "run_publish", "run_marts"]
    assert rows_of(spark.table("resumed.movies"), "movie_id") == [(1,), (2,)]
