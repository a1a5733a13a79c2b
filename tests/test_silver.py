"""The 18 silver tables over hand-written documents."""

import datetime as dt
import json

import pytest
from conftest import plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from snapstar.operators.explode import explode_child
from snapstar.plans.examples import first_example, flatten_documents, second_example
from snapstar.plans.parse import parse_documents, readable
from snapstar.plans.silver import advance_dim, build_silver, movies, read_silver, silver_table
from snapstar.schemas import CHILDREN, DIMS, HISTORY_TABLES, PARSED_DDL, RAW_DDL, SILVER_TABLES, Child, Level
from snapstar.sinks.write import append_days
from snapstar.sources.tables import read_table

D1, D2 = dt.date(2026, 4, 8), dt.date(2026, 4, 9)


def documents(spark, items):
    data = [(doc.get("id"), json.dumps(doc), f"f{i}", day) for i, (day, doc) in enumerate(items)]
    return readable(parse_documents(spark.createDataFrame(data, RAW_DDL)))


def person(id, name, popularity=None, **more):
    return {"id": id, "name": name, "popularity": popularity, **more}


FILM = {
    "id": 10,
    "title": "T",
    "release_date": "2026-02-30",
    "genres": [{"id": 1, "name": "G"}, {"id": 1, "name": "G"}, None, {"id": None, "name": "X"}, {}],
    "production_companies": [{"id": 5, "name": "C", "origin_country": "US", "logo_path": "/l"}],
    "production_countries": [{"iso_3166_1": "US", "name": "States"}],
    "spoken_languages": [{"iso_639_1": "en", "english_name": "English", "name": None}],
    "origin_country": ["US", None, "US", "FR"],
    "credits": {
        "cast": [person(1, "P", 1.0, order=0, character="R", credit_id="a", cast_id=4)],
        "crew": [person(1, "P", None, job="Writer", department="W", credit_id="b"), person(None, None)],
    },
    "keywords": {"keywords": [{"id": 3, "name": "k"}]},
    "release_dates": {
        "results": [
            {"iso_3166_1": "US", "release_dates": [{"certification": "PG", "release_date": "2026-01-01", "type": 3}]},
            {"iso_3166_1": "FR", "release_dates": []},
            {"iso_3166_1": "DE", "release_dates": None},
            None,
        ]
    },
    "videos": {"results": [{"id": "v", "key": "k", "site": "S", "official": True}, {"name": "no id"}]},
}


@pytest.fixture(scope="module")
def film(spark):
    return documents(spark, [(D1, FILM), (D1, {"id": 11})])


@pytest.mark.parametrize(
    "table,columns,expected",
    [
        ("movies", ["movie_id", "title", "release_date"], [(10, "T", None), (11, None, None)]),
        ("fact_movie_daily_snapshot", ["movie_id", "snapshot_date"], [(10, D1), (11, D1)]),
        ("movie_genres", ["genre_id", "genre_name"], [(None, "X"), (1, "G")]),
        ("movie_production_companies", ["company_id", "company_origin_country"], [(5, "US")]),
        ("movie_production_countries", ["country_code", "country_name"], [("US", "States")]),
        ("movie_spoken_languages", ["language_code", "language_name"], [("en", None)]),
        ("movie_origin_countries", ["movie_id", "country_code"], [(10, "FR"), (10, "US")]),
        ("movie_cast", ["person_id", "cast_order", "character", "cast_id"], [(1, 0, "R", 4)]),
        ("movie_crew", ["person_id", "job", "department"], [(1, "Writer", "W")]),
        ("movie_keywords", ["keyword_id", "keyword_name"], [(3, "k")]),
        (
            "movie_release_dates",
            ["country_code", "certification", "release_type"],
            [("DE", None, None), ("FR", None, None), ("US", "PG", 3)],
        ),
        ("movie_videos", ["video_id", "video_key", "official"], [("v", "k", True)]),
        ("dim_genre", ["genre_id", "genre_name"], [(None, "X"), (1, "G")]),
        ("dim_person", ["person_id", "person_popularity"], [(1, 1.0)]),
    ],
)
def test_tables(film, table, columns, expected):
    assert rows_of(silver_table(film, table), *columns) == expected


def test_every_table_has_its_columns(film):
    for table in SILVER_TABLES:
        columns = silver_table(film, table).columns
        assert ("snapshot_date" in columns) == (table not in HISTORY_TABLES)


def test_prototype_keeps_everything(film):
    flat = flatten_documents(film)
    assert set(flat) == {"movies", *CHILDREN}
    assert rows_of(flat["movie_genres"], "movie_id", "genre_id", "genre_name") == [
        (10, None, None),
        (10, None, None),
        (10, None, "X"),
        (10, 1, "G"),
        (10, 1, "G"),
        (11, None, None),
    ]
    assert flat["movie_origin_countries"].columns[-1] == "origin_country_code"
    assert flat["movie_release_dates"].count() == 5


def test_duplicate_documents_leave_one_film(spark):
    twice = documents(spark, [(D1, {"id": 1, "title": "B"}), (D1, {"id": 1, "title": "A"}), (D2, {"id": 1})])
    assert rows_of(movies(twice), "snapshot_date", "title") == [(D1, "A"), (D2, None)]


def test_dim_takes_the_last_name(spark):
    docs = documents(
        spark,
        [
            (D1, {"id": 1, "genres": [{"id": 1, "name": "A"}, {"id": 2, "name": "Z"}, {"id": None, "name": "n"}]}),
            (D2, {"id": 1, "genres": [{"id": 1, "name": "C"}, {"id": 1, "name": "B"}]}),
        ],
    )
    assert rows_of(silver_table(docs, "dim_genre")) == [(None, "n"), (1, "B"), (2, "Z")]


@pytest.mark.parametrize("table", HISTORY_TABLES)
def test_advanced_dims_equal_rebuilt_ones(spark, table):
    first = {**FILM, "genres": [{"id": 1, "name": "old"}, {"id": 2, "name": "gone"}, {"id": None, "name": "n"}]}
    docs = documents(spark, [(D1, first), (D2, FILM), (D2, {**FILM, "id": 12})])
    before = silver_table(docs.filter(docs.snapshot_date == D1), table)
    advanced = advance_dim(before, docs.filter(docs.snapshot_date == D2), table)
    assert rows_of(advanced) == rows_of(silver_table(docs, table))


def test_person_ties_follow_the_name(spark):
    cast = [person(1, "B", 2.0), person(1, "A", 2.0), person(1, "0", None), person(2, "N", None)]
    docs = documents(spark, [(D1, {"id": 1, "credits": {"cast": cast, "crew": []}})])
    assert rows_of(silver_table(docs, "dim_person"), "person_id", "person_name") == [(1, "A"), (2, "N")]


def test_only_the_needed_fields_are_read(spark, film, root):
    append_days(film, root + "/t")
    history = read_table(spark, root + "/t", PARSED_DDL)
    genres = plan_of(silver_table(history, "movie_genres"))
    assert "ReadSchema: struct<genres:array<struct<id:bigint,name:string>>,id:bigint>" in genres
    assert genres.count("Exchange") == 1
    people = plan_of(silver_table(history, "dim_person"))
    assert "character:string" not in people and "credit_id:string" not in people
    assert people.count("WindowGroupLimit") == 2


def test_build_silver_modes(spark, film, root):
    append_days(film, root + "/parsed")
    for _ in range(2):
        build_silver(spark, root + "/parsed", root + "/append", D1, "append")
        build_silver(spark, root + "/parsed", root + "/replace", D1, "replace_day", state_root=root + "/replace")
    for table in SILVER_TABLES:
        once = silver_table(film, table).count()
        times = 1 if table in HISTORY_TABLES else 2
        assert read_table(spark, f"{root}/append/{table}").count() == times * once
        assert read_silver(spark, f"{root}/replace", table).count() == once


def test_examples(spark):
    first = first_example(spark)
    assert rows_of(first) == [(None,), (1,)]
    assert rows_of(second_example(first)) == [(1,)]


NESTED = Child((Level("outer", "key"), Level("items", "value", keep_empty=True)), "key, value")
text = st.one_of(st.none(), st.sampled_from("abc"))
items = st.one_of(st.none(), st.lists(st.builds(lambda v: {"value": v}, text), max_size=3))
outer = st.one_of(st.none(), st.lists(st.builds(lambda k, i: {"key": k, "items": i}, text, items), max_size=3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(outer, min_size=1, max_size=6))
def test_two_levels_against_loops(spark, nested):
    ddl = "id bigint, snapshot_date date, outer array<struct<key: string, items: array<struct<value: string>>>>"
    df = spark.createDataFrame([(i, D1, o) for i, o in enumerate(nested)], ddl)
    expected = []
    for i, o in enumerate(nested):
        for entry in o or []:
            for item in entry["items"] or [{"value": None}]:
                if entry["key"] is not None or item["value"] is not None:
                    expected.append((i, D1, entry["key"], item["value"]))
    found = rows_of(explode_child(df, NESTED))
    assert found == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("dim", DIMS)
def test_narrowed_explode_equals_the_full_one(film, dim):
    child, columns = CHILDREN[DIMS[dim].child], [c.strip() for c in DIMS[dim].columns.split(",")]
    full = explode_child(film, child).select(*columns)
    assert rows_of(explode_child(film, child, [], only=columns), *columns) == rows_of(full)
