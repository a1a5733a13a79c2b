"""Raw documents with every anomaly the parser has to bear."""

import datetime as dt
import json

import pytest
from conftest import plan_of, rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from snapstar.functions.columns import day_from_path, lookback, run_date, safe_date
from snapstar.plans.parse import parse_documents, parse_landed, parse_raw, readable, rejected
from snapstar.schemas import PARSED_DDL, RAW_DDL
from snapstar.sources.raw import read_inferred, read_raw_files
from snapstar.sources.tables import one_day, read_if_exists, read_or_empty, read_table

CASES = [
    ("{bad json", None),
    ('{"id":"notnum","budget":7}', None),
    ('[{"id":5}]', None),
    ('{"id":4,"budget":1.5}', {"budget": None}),
    ('{"id":1,"popularity":"abc","budget":3}', {"popularity": None, "budget": 3}),
    ('{"id":7,"genres":{"id":3},"title":"t"}', {"genres": None, "title": "t"}),
    ('{"id":2,"belongs_to_collection":{"id":9,"name":"C"}}', {"belongs_to_collection": '{"id":9,"name":"C"}'}),
    ('{"id":8} trailing', {"id": 8}),
    ('{\n  "id": 6,\n  "title": "pretty"\n}', {"title": "pretty"}),
    ('{"id":3,"genres":[{"id":1,"name":"A"},null]}', {"genres": [(1, "A"), None]}),
]


def raw(spark, texts):
    data = [(i, text, f"f{i}", dt.date(2026, 4, 8)) for i, text in enumerate(texts)]
    return spark.createDataFrame(data, RAW_DDL)


@pytest.mark.parametrize("text,expected", CASES)
def test_anomalies(spark, text, expected):
    parsed = parse_documents(raw(spark, [text]))
    good = readable(parsed).collect()
    assert len(good) == (expected is not None)
    assert rejected(parsed).count() == (expected is None)
    for field, value in (expected or {}).items():
        found = good[0][field]
        if isinstance(value, list):
            found = [tuple(x) if x else None for x in found]
        assert found == value


def test_null_text_is_rejected(spark):
    parsed = parse_documents(raw(spark, [None, '{"id":1}']))
    assert rows_of(readable(parsed), "id") == [(1,)]


def test_a_document_is_parsed_once(spark):
    plan = plan_of(readable(parse_documents(raw(spark, ['{"id":1}']))))
    assert plan.count("from_json") == 1


def write_files(root, files):
    for path, text in files.items():
        file = root / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)


def test_files_of_a_day(spark, tmp_path):
    write_files(
        tmp_path,
        {
            "snapshot_date=2026-04-08/movie_id=1.json": json.dumps({"id": 1, "title": "A"}, indent=2),
            "snapshot_date=2026-04-08/movie_id=2.json": "{bad",
            "snapshot_date=2026-04-08/movie_id=3.json": "",
            "snapshot_date=2026-04-08/other.json": '{"id":9}',
            "snapshot_date=2026-04-09/movie_id=1.json": '{"id":1,"title":"B"}',
        },
    )
    root, parsed = f"file://{tmp_path}", f"{tmp_path}/parsed"
    files = read_raw_files(spark, root, "2026-04-08")
    day = dt.date(2026, 4, 8)
    # An empty file holds no text, so it is no row.
    assert rows_of(files, "movie_id", "snapshot_date") == [(1, day), (2, day)]
    assert files.filter(F.col("source_file").endswith("movie_id=1.json")).count() == 1
    for _ in range(2):
        parse_raw(spark, root, parsed, "2026-04-08", mode="replace_day")
    assert rows_of(read_table(spark, parsed, PARSED_DDL), "id", "title") == [(1, "A")]
    parse_raw(spark, root, parsed, "2026-04-08")
    parse_raw(spark, root, parsed, "2026-04-09")
    assert rows_of(read_table(spark, parsed, PARSED_DDL), "id", "title") == [(1, "A"), (1, "A"), (1, "B")]
    assert rows_of(one_day(read_table(spark, parsed, PARSED_DDL), "2026-04-09"), "title") == [("B",)]


def test_landed_table_is_parsed_without_a_shuffle(spark, root):
    landed = raw(spark, ['{"id":1}', '{"id":2}'])
    assert "Exchange" not in plan_of(readable(parse_documents(landed)))
    parse_landed(landed, root + "/parsed")
    assert read_table(spark, root + "/parsed", PARSED_DDL).count() == 2


def test_inferred_schema(spark, tmp_path):
    write_files(tmp_path, {"a.json": '{\n "id": 5,\n "genres": [{"id": 1, "name": "G"}]\n}'})
    documents = read_inferred(spark, f"{tmp_path}/a.json", "2026-04-05")
    assert rows_of(documents, "id", "snapshot_date") == [(5, dt.date(2026, 4, 5))]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("", None),
        ("2026-02-30", None),
        ("x", None),
        (None, None),
        ("2026-4-8", dt.date(2026, 4, 8)),
        ("2026", dt.date(2026, 1, 1)),
        ("2026-04-08T01:02:03Z", dt.date(2026, 4, 8)),
    ],
)
def test_safe_date(spark, text, expected):
    assert spark.createDataFrame([(text,)], "t string").select(safe_date(F.col("t"))).first()[0] == expected


def test_day_from_path(spark):
    paths = [("s3://b/snapshot_date=2026-04-08/movie_id=1.json",), ("s3://b/movie_id=1.json",)]
    found = spark.createDataFrame(paths, "p string").select(day_from_path(F.col("p"))).collect()
    assert [r[0] for r in found] == [dt.date(2026, 4, 8), None]


def test_run_date_and_lookback(spark):
    assert run_date("2026-04-08") == "2026-04-08"
    assert run_date() == str(dt.date.today())
    days = spark.sql("select explode(sequence(date'2026-04-05', date'2026-04-09')) as d")
    found = [r.d.day for r in days.filter(lookback(F.col("d"), "2026-04-08", 1)).collect()]
    assert found == [7, 8]


def test_missing_and_empty_tables(spark, root):
    assert read_if_exists(spark, root + "/none", RAW_DDL) is None
    assert read_or_empty(spark, root + "/none", RAW_DDL).count() == 0
    raw(spark, []).write.partitionBy("snapshot_date").parquet(root + "/empty")
    assert read_if_exists(spark, root + "/empty", RAW_DDL).count() == 0


def test_one_day_prunes_partitions(spark, root):
    raw(spark, ["{}"]).write.partitionBy("snapshot_date").parquet(root + "/t")
    plan = plan_of(one_day(read_table(spark, root + "/t", RAW_DDL), "2026-04-08"))
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_many_files_have_folders_as_root_paths(spark, tmp_path):
    write_files(tmp_path, {f"snapshot_date=2026-04-0{d}/movie_id={i}.json": f'{{\n "id": {i}\n}}' for d in (5, 6) for i in (1, 2)})
    write_files(tmp_path, {"snapshot_date=2026-04-05/window=a/movie_id=9.json": '{"id": 9, "late": 1}', "snapshot_date=2026-04-05/other.json": "{}"})
    documents = read_inferred(spark, f"{tmp_path}/snapshot_date=*/movie_id=*.json", "2026-04-05")
    assert documents.columns == ["id", "snapshot_date"]
    assert sorted(r.id for r in documents.collect()) == [1, 1, 2, 2]
    assert "InMemoryFileIndex(2 paths)" in plan_of(documents)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_inferred(spark, f"{tmp_path}/snapshot_date=*/film=*.json")
