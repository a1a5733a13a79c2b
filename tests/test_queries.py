"""Every query against its SQL over the given tables."""

import math

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from snapstar import catalog  # noqa: E402
from conftest import DATA, plan_of  # noqa: E402

TABLES = """
region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations
""".split()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return connection


def text(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    found = sorted(tuple(text(row[c]) for c in columns) for row in df.collect())
    cursor = con.execute(entry.oracle_sql()[name])
    header = [d[0] for d in cursor.description]
    assert sorted(header) == columns
    expected = sorted(tuple(text(row[header.index(c)]) for c in columns) for row in cursor.fetchall())
    assert found == expected
    assert found
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEval" not in plan


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["movie_id", "person_id", "character", "cast_order", "credit_id"]
    assert df.count() > 0
