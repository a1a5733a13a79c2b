"""Very many files are listed and opened by tasks, with the rows that Spark's own scans give."""

import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import plan_of
from snapstar.plans.landing import absent_files, land_files
from snapstar.schemas import RAW_DDL
from snapstar.sources import files
from snapstar.sources.discovery import listed, missing_pages, read_pages
from snapstar.sources.raw import file_paths, named_files, read_inferred, read_raw_files, slice_of
from snapstar.sources.tables import read_table

DAY = "2026-04-08"
ODD = {
    "movie_id=1.json": b'{"id": 1, "title": "\xc3\x9c"}\n',
    "movie_id=a b%20c#?[d].json": b'{"id": "x"}',
    "movie_id= +&,'(~)!$;@\".json": b'[{"id": 2}, {"id": 3, "page": "x", "total_pages": 4}]',
    "movie_id=3.json": b"",
    "movie_id=4.json": b"  \n ",
    "movie_id=5.json": b"{bad",
    "movie_id=6.json": b'{"id": 6, "title": "\xff\xfe"}',
    "movie_id=7.json": '{"id": 7, "title": "é"}'.encode("utf-16"),
    "movie_id=8.json": b'\xef\xbb\xbf{"id": 8}',
    "movie_id=9.json": b'{"id": 1.5, "results": {"id": 3}}',
    "movie_id=10.json": b"[]",
    "movie_id=11.json": b"null",
    "movie_id=12.json": b'{"id": 12} trailing',
    "movie_id=13.txt": b'{"id": 13}',
    "_movie_id=14.json": b'{"id": 14}',
    "other.json": b"{}",
}


@pytest.fixture
def by(monkeypatch):
    """Calls with the files listed by Spark and by tasks."""

    def both(call):
        found = []
        for most in (1 << 40, 0):
            monkeypatch.setattr(files, "LISTED", most)
            found.append(call())
        monkeypatch.setattr(files, "LISTED", 0)
        return found

    return both


@pytest.fixture
def odd(tmp_path):
    folder = tmp_path / "od d" / f"snapshot_date={DAY}"
    folder.mkdir(parents=True)
    for name, content in ODD.items():
        (folder / name).write_bytes(content)
    (tmp_path / "od d" / "snapshot_date=2026-04-09").mkdir()
    (tmp_path / "od d" / "snapshot_date=2026-04-09" / "movie_id=1.json").write_bytes(b'{"id": 1}')
    return f"{tmp_path}/od d"


def raw_rows(df):
    return sorted(df.select("source_file", "snapshot_date", "movie_id", F.hex("raw_json")).collect())


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_and_paths_are_those_of_a_scan(spark, odd, by):
    for root in (odd, f"file:{odd}", f"file://{odd}"):
        for day in (DAY, None):
            scanned, tasks = by(lambda: read_raw_files(spark, root, day))  # noqa: B023
            assert raw_rows(scanned) == raw_rows(tasks) and len(raw_rows(tasks)) >= 11
            assert "MapInArrow" in plan(tasks) and "MapInArrow" not in plan(scanned)
        scanned, tasks = by(lambda: file_paths(spark, root, DAY))  # noqa: B023
        assert sorted(scanned.collect()) == sorted(tasks.collect()) and tasks.count() == 12
    some = [r[0] for r in tasks.select(slice_of("source_file")).limit(3).collect()]
    scanned, tasks = by(lambda: read_raw_files(spark, odd, DAY, some))
    assert raw_rows(scanned) == raw_rows(tasks)


def test_documents_are_those_of_a_scan(spark, odd, by):
    pattern, ddl = f"{odd}/snapshot_date=*/movie_id=*.json", "id bigint, title string, page int, total_pages int, results array<struct<id: bigint>>"
    scanned, tasks = by(lambda: named_files(spark, pattern, ddl).select("_metadata.file_path", "id", "title", "page", "total_pages", F.col("results.id")))
    assert sorted(map(str, scanned.collect())) == sorted(map(str, tasks.collect()))
    assert "MapInArrow" in plan(tasks)


@pytest.mark.parametrize("once", [False, True])
def test_inferred_documents_are_those_of_a_scan(spark, odd, by, once):
    for name in ("movie_id=6.json", "movie_id=7.json", "movie_id=8.json", "movie_id=5.json"):
        Path(f"{odd}/snapshot_date={DAY}/{name}").unlink()
    pattern = f"{odd}/snapshot_date=*/movie_id=*.json"
    scanned, tasks = by(lambda: read_inferred(spark, pattern, once=once))
    assert scanned.dtypes == tasks.dtypes
    assert sorted(map(str, scanned.collect())) == sorted(map(str, tasks.collect()))
    for wrong in (f"{odd}/snapshot_date=*/film=*.json", f"{odd}/none=*/movie_id=*.json"):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            read_inferred(spark, wrong, once=once)


def test_what_lies_beside_files_is_left_to_a_scan(spark, odd, by):
    day = Path(f"{odd}/snapshot_date=2026-04-09")
    (day / "window=a").mkdir()
    (day / "window=a" / "movie_id=2.json").write_text('{"id": 2}')
    scanned, tasks = by(lambda: read_raw_files(spark, odd, day.name.partition("=")[2]))
    assert raw_rows(scanned) == raw_rows(tasks) and "MapInArrow" not in plan(tasks)
    scanned, tasks = by(lambda: named_files(spark, f"{odd}/snapshot_date=*/movie_id=*.json", "id bigint").select("id"))
    assert sorted(map(str, scanned.collect())) == sorted(map(str, tasks.collect()))


def test_files_land_as_before(spark, odd, by, root):
    def land():
        path = f"{root}/raw-{files.LISTED}"
        counts = [land_files(spark, odd, path, DAY), land_files(spark, odd, path, DAY)]
        late = Path(f"{odd}/snapshot_date={DAY}/movie_id=late.json")
        late.write_text("{}")
        counts += [land_files(spark, odd, path, DAY), land_files(spark, odd, path, DAY, replace=True)]
        late.unlink()
        return counts, raw_rows(read_table(spark, path, RAW_DDL))

    scanned, tasks = by(land)
    assert scanned == tasks and tasks[0] == [12, 0, 1, 13]


def test_pages_of_a_listing(spark, root, by):
    folder = Path(root) / f"snapshot_date={DAY}"
    folder.mkdir()
    for n in (1, 3, 4):
        (folder / f"page={n}.json").write_text(json.dumps({"page": n, "total_pages": 3, "results": [{"id": n}, {"id": 9}] if n < 4 else None}, indent=1))
    for call in (lambda: missing_pages(read_pages(spark, root)), lambda: listed(read_pages(spark, root, DAY))):
        scanned, tasks = by(call)
        assert sorted(map(str, scanned.collect())) == sorted(map(str, tasks.collect())) and "MapInArrow" in plan(tasks)


def test_the_driver_is_left_out_of_large_folders(spark, odd, monkeypatch):
    """No index of the files is made, and neither their names nor their sizes come to the driver."""
    monkeypatch.setattr(files, "LISTED", 5)
    for rows in (read_raw_files(spark, odd), file_paths(spark, odd, DAY), named_files(spark, f"{odd}/snapshot_date=*/movie_id=*.json", "id bigint")):
        assert not rows.inputFiles() and "LocalRelation" in plan(rows) or "LogicalRDD" in plan(rows)
        assert "movie_id=1.json" not in plan(rows)


def test_very_many_paths_are_not_broadcast(spark, odd, root, monkeypatch):
    monkeypatch.setattr(files, "LISTED", 5)
    assert land_files(spark, odd, f"{root}/raw", DAY) == 12
    absent = absent_files(spark, odd, f"{root}/raw", DAY)
    assert "Broadcast" not in plan_of(absent) and absent.count() == 0
    monkeypatch.setattr(files, "LISTED", 1 << 40)
    assert "Broadcast" in plan_of(absent_files(spark, odd, f"{root}/raw", DAY))
