"""Universe, publishing, checks and whole days."""

import datetime as dt
import json

import pytest
from conftest import plan_of, rows_of

from snapstar.__main__ import arguments, run
from snapstar.functions.columns import day_literal, run_date
from snapstar.operators.quality import check_report, declared_checks, duplicate_keys, null_rows
from snapstar.plans.daily import read_marts, run_checks, run_day
from snapstar.plans.examples import first_example, literal_rows, second_example
from snapstar.plans.landing import land_files
from snapstar.plans.universe import IncompleteListing, backfill, update_universe
from snapstar.schemas import CHILDREN, SILVER_TABLES
from snapstar.session import scratch
from snapstar.sinks.publish import publish
from snapstar.sinks.write import inspect
from snapstar.sources import state
from snapstar.sources.state import add_ids, known_ids, load_ids, read_id_array, save_ids
from snapstar.sources.discovery import released_between
from snapstar.sources.tables import partition_values, source_tables


def write_json(path, payload):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload, indent=2, ensure_ascii=False))


def entry(id, day, **flags):
    return {"id": id, "title": f"Ü{id}", "release_date": day, "adult": False, "video": False, **flags}


def test_state(spark, root):
    assert load_ids(spark, root + "/s").count() == 0
    for ids in ([3, 1], [5], [2, 4]):
        path = save_ids(spark, spark.createDataFrame([(i,) for i in ids], "movie_id bigint"), root + "/s")
    assert path.endswith("version=3")
    assert [r[0] for r in load_ids(spark, root + "/s").collect()] == [2, 4]
    for i in range(9):
        save_ids(spark, spark.createDataFrame([(i,)], "movie_id bigint"), root + "/s")
    assert len(partition_values(spark, root + "/s", "version")) == 5
    assert load_ids(spark, root + "/s").first()[0] == 8


def test_log_of_ids(spark, root, monkeypatch):
    """Runs add what is new; the log is merged now and then, and a day's ids read a part of it."""
    monkeypatch.setattr(state, "MERGED", 3)
    ids = lambda *values: spark.createDataFrame([(i,) for i in values], "movie_id bigint")
    path = root + "/s"
    seen, folders = set(), []
    for i in range(8):
        new = {10 * i, 10 * i + 1}
        folders.append(add_ids(spark, ids(*new), path).rpartition("/")[2])
        seen |= new
        assert rows_of(load_ids(spark, path)) == sorted((i,) for i in seen)
    assert folders == ["version=1", "delta=1-1", "delta=1-2", "version=2", "delta=2-1", "delta=2-2", "version=3", "delta=3-1"]
    for _ in range(7):
        save_ids(spark, ids(*seen), path)
    assert partition_values(spark, path, "delta") == [] and len(partition_values(spark, path, "version")) == 5
    assert rows_of(known_ids(load_ids(spark, path), ids(1, 2, 71))) == [(1,), (71,)]
    assert known_ids(load_ids(spark, path), ids()).count() == 0
    spark.range(1_000_000).selectExpr("id as movie_id").write.option("parquet.block.size", 1 << 20).parquet(path + "/many")
    many = spark.read.parquet(path + "/many")
    few = known_ids(many, ids(999_998, 1_000_005))
    assert rows_of(few) == [(999_998,)] and "Exchange hashpartitioning" not in plan_of(few).split("BroadcastExchange")[0].split("HashAggregate")[-1]


def test_lost_page(spark, tmp_path):
    day, pages, log = "2026-04-08", tmp_path / "discover", f"{tmp_path}/state"
    for page in (1, 3):
        write_json(
            pages / f"snapshot_date={day}" / f"page={page}.json",
            {"page": page, "total_pages": 3, "results": [entry(page, day)]},
        )
    with pytest.raises(IncompleteListing, match="2 of 3"):
        update_universe(spark, str(pages), log, day)
    assert load_ids(spark, log).count() == 0
    write_json(pages / f"snapshot_date={day}" / "page=2.json", {"page": 2, "total_pages": 3, "results": []})
    assert update_universe(spark, str(pages), log, day).first().universe_size == 2


def test_run_date_defaults_to_today(spark):
    assert run_date() == str(dt.date.today()) and run_date("2026-04-08") == "2026-04-08"
    assert spark.range(1).select(day_literal()).first()[0] == dt.date.today()


def test_sorted_outputs_are_sorted(spark, root):
    ids = spark.range(5000).selectExpr("(id * 7919) % 5000 as movie_id").repartition(5)
    folder = save_ids(spark, ids, root + "/s")
    assert [r[0] for r in spark.read.parquet(folder).collect()] == list(range(5000))
    entries = spark.createDataFrame(
        [(i, f"2026-04-{i % 28 + 1:02d}", False, False) for i in range(300)],
        "id long, release_date string, adult boolean, video boolean",
    )
    found = [(r.release_date, r.id) for r in released_between(entries.repartition(4), "2026-04-01", "2026-04-20").collect()]
    assert found == sorted(found) and len(found) > 100


@pytest.mark.parametrize("indent", [2, None])
def test_id_array(spark, tmp_path, indent):
    (tmp_path / "ids.json").write_text(json.dumps([3, 10, "12", 3], indent=indent))
    assert rows_of(read_id_array(spark, f"{tmp_path}/ids.json")) == [(10,), (12,), (3,)]


def test_universe(spark, tmp_path):
    day, pages, log = "2026-04-08", tmp_path / "discover", f"{tmp_path}/state"
    write_json(
        pages / f"snapshot_date={day}" / "page=1.json",
        {"page": 1, "total_pages": 2, "results": [entry(1, day), entry(2, day, adult=True), entry(3, "2026-04-07")]},
    )
    write_json(
        pages / f"snapshot_date={day}" / "page=2.json",
        {"page": 2, "total_pages": 2, "results": [entry(1, day), entry(4, day, video=None), {"release_date": day}]},
    )
    save_ids(spark, spark.createDataFrame([(4,), (9,)], "movie_id bigint"), log)
    metrics = update_universe(spark, str(pages), log, day).first().asDict()
    assert metrics == {
        "existing": 2, "discovered": 2, "truly_new": 1, "succeeded": 0, "failed": 3, "universe_size": 3,
    }
    assert rows_of(load_ids(spark, log)) == [(1,), (4,), (9,)]
    write_json(
        pages / "snapshot_date=2026-04-09" / "window=2026-04-05_2026-04-07" / "page=1.json",
        {"page": 1, "total_pages": 1, "results": [entry(20, "2026-04-05"), entry(21, "2026-04-08")]},
    )
    metrics = backfill(spark, str(pages), log, "2026-04-05", "2026-04-07", "2026-04-09").first()
    assert (metrics.discovered, metrics.universe_size) == (1, 4)


def test_publish_goes_on_after_a_failure(spark, root):
    rows = spark.createDataFrame([(1, dt.date(2026, 4, 8)), (2, dt.date(2026, 4, 9))], "movie_id int, snapshot_date date")
    audit = publish(spark, {"movies": rows, "gone": root + "/none"}, "pub", root + "/pub")
    assert rows_of(audit, "table_name", "status", "num_rows") == [("gone", "failed", None), ("movies", "loaded", 2)]
    assert "PATH_NOT_FOUND" in audit.filter("status = 'failed'").first().error
    later = spark.createDataFrame([(3, dt.date(2026, 4, 9)), (4, dt.date(2026, 4, 8))], rows.schema)
    audit = publish(spark, {"movies": later}, "pub", root + "/pub", day="2026-04-09")
    assert audit.first().num_rows == 1
    assert rows_of(spark.table("pub.movies"), "movie_id") == [(1,), (3,)]
    publish(spark, {"movies": rows}, "pub", root + "/pub", replace=False)
    assert spark.table("pub.movies").count() == 4


def test_checks(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, "c")], "id int, name string")
    assert null_rows(rows, "id").count() == 2
    assert rows_of(duplicate_keys(rows, "id")) == [(1, 2)]
    assert duplicate_keys(rows, ["id", "name"]).count() == 0
    report = check_report({"m": rows}, "m id not_null unique\nm name not_null\nother id unique")
    assert rows_of(report) == [("m", "id", "not_null", 2), ("m", "id", "unique", 1), ("m", "name", "not_null", 1)]
    first = first_example(spark)
    report = check_report({"first_example": first, "second_example": second_example(first)})
    assert [r[3] for r in rows_of(report)] == [1, 0, 0, 0]


def test_literal_rows(spark):
    assert rows_of(literal_rows(spark.range(2))) == [(None,), (None,), (1,), (1,)]


def test_declared_checks():
    tests = [t for _, _, tests in declared_checks() for t in tests]
    assert (tests.count("not_null"), tests.count("unique")) == (23, 9)


def film(id, name, people, genre):
    credit = [{"id": p, "name": f"P{p}", "credit_id": f"c{p}", "popularity": 1.0 * p} for p in people]
    return {
        "id": id, "title": name, "popularity": 1.5, "genres": [{"id": genre, "name": f"G{genre}"}],
        "credits": {"cast": credit, "crew": credit[:1]},
    }


def test_days(spark, tmp_path):
    files, root = tmp_path / "files", str(tmp_path / "wh")
    days = {
        "2026-04-08": [film(1, "one", [1, 2], 7), film(2, "two", [3], 8)],
        "2026-04-09": [film(1, "uno", [1], 9)],
        "2026-04-07": [film(3, "three", [5], 7)],
    }
    for day, films in days.items():
        for document in films:
            write_json(files / f"snapshot_date={day}" / f"movie_id={document['id']}.json", document)
    write_json(files / "snapshot_date=2026-04-09" / "movie_id=9.json", {"status_message": "not found"})

    def snapshot():
        tables = {t: spark.table(f"days.{t}") for t in SILVER_TABLES}
        tables |= {f"mart {t}": df for t, df in read_marts(spark, f"{root}/marts").items()}
        return {name: rows_of(df.drop("source_file"), *sorted(df.drop("source_file").columns)) for name, df in tables.items()}

    for day in ("2026-04-08", "2026-04-09"):
        audit = run_day(spark, str(files), root, "days", day)
    assert audit.filter("status = 'loaded'").count() == len(SILVER_TABLES)
    two = snapshot()
    assert len(two["movies"]) == len(two["mart fct_movie_daily_snapshot"]) == 3
    assert [r[-1] for r in two["mart dim_movie"]] == [None, None]  # video
    assert len(two["mart bridge_movie_cast"]) == 3  # a credit that vanished stays
    assert len(two["dim_genre"]) == 3
    run_day(spark, str(files), root, "days", "2026-04-09")
    assert snapshot() == two
    run_day(spark, str(files), root, "days", "2026-04-07")
    late = snapshot()
    assert len(late["movies"]) == 4 and len(late["mart dim_movie"]) == 3
    assert len(late["mart bridge_movie_cast"]) == 4 and len(late["dim_person"]) == 4
    assert late["mart fct_movie_daily_snapshot"] == two["mart fct_movie_daily_snapshot"]
    # A rerun of the last day goes on from states that know the late day; the next day too.
    run_day(spark, str(files), root, "days", "2026-04-09")
    assert snapshot() == late
    # A film that lost its genres, and a day of which nothing is readable any more.
    write_json(files / "snapshot_date=2026-04-09" / "movie_id=1.json", {"id": 1, "title": "uno", "genres": []})
    land_files(spark, str(files), f"{root}/raw", "2026-04-09", replace=True)
    run_day(spark, str(files), root, "days", "2026-04-09")
    assert not [r for r in snapshot()["movie_genres"] if dt.date(2026, 4, 9) in r]
    assert len(snapshot()["dim_genre"]) == 2
    write_json(files / "snapshot_date=2026-04-09" / "movie_id=1.json", {"status_message": "not found"})
    land_files(spark, str(files), f"{root}/raw", "2026-04-09", replace=True)
    run_day(spark, str(files), root, "days", "2026-04-09")
    assert len(snapshot()["movies"]) == 3
    report = run_checks(spark, "days", f"{root}/marts")
    assert report.count() == 32
    assert rows_of(report.filter("violations > 0")) == [("first_example", "id", "not_null", 1)]


def test_sources_and_views(spark, capsys):
    tables = {name: spark.range(1) for name in SILVER_TABLES}
    assert len(source_tables(tables)) == 13
    inspect(spark.createDataFrame([("a" * 50,)], "text string"))
    assert "a" * 50 in capsys.readouterr().out
    assert len(CHILDREN) == 10


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch(spark, "x")
    assert path != scratch(spark, "x")
    if shared:
        assert path.startswith(shared)


def test_command_line(spark, tmp_path):
    write_json(tmp_path / "files" / "snapshot_date=2026-04-08" / "movie_id=1.json", film(1, "one", [1], 7))
    files, parsed, silver = f"{tmp_path}/files", f"{tmp_path}/parsed", f"{tmp_path}/silver"
    day = ["--date", "2026-04-08"]
    run(spark, arguments(["parse", "--files", files, "--parsed", parsed, *day]))
    run(spark, arguments(["silver", "--parsed", parsed, "--silver", silver, *day]))
    run(spark, arguments(["land", "--files", files, "--raw", f"{tmp_path}/raw", *day]))
    assert spark.read.parquet(f"{silver}/movie_genres").first().genre_id == 7
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 1
    root = ["--root", f"{tmp_path}/wh", "--database", "jobs"]
    run(spark, arguments(["day", "--files", files, *root, *day]))
    assert run(spark, arguments(["publish", *root, *day])).filter("status = 'loaded'").count() == len(SILVER_TABLES)
    marts = f"{tmp_path}/wh/marts/fct_movie_daily_snapshot"
    run(spark, arguments(["marts", *root, *day, "--full-refresh"]))
    assert spark.read.parquet(marts).count() == 1
    assert run(spark, arguments(["land", "--files", files, "--raw", f"{tmp_path}/raw", *day])).first().landed == 0
    assert arguments(["checks", "--root", "r", "--database", "d"]).date == str(dt.date.today())


def test_new_ids_keep_their_tasks(spark, root):
    path = f"{root}/state"
    save_ids(spark, spark.range(3).toDF("movie_id"), path)
    add_ids(spark, spark.range(3, 20_003, 1, 4).selectExpr("id + 100000L * spark_partition_id() as movie_id"), path)
    assert load_ids(spark, path).count() == 20_003
    assert load_ids(spark, path).selectExpr("movie_id div 100000").distinct().count() == 4  # not all in one task
