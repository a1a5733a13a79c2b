import hashlib
import math
import re
from collections import Counter

import duckdb
import pytest
from corpus import docs, empty, key, rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from snapstar.llm import mixing


def plain_targets(sizes):
    """Fill up the sources in rounds, as the words of the contract say."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in order if x not in capped) for s in order if s not in capped}
        over = {s for s, t in share.items() if t > 2 * sizes[s] + 1e-9}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else share[s] for s in order}
        capped |= over


@given(st.lists(st.integers(0, 50), min_size=1, max_size=9))
@settings(max_examples=15, deadline=None)
def test_targets(spark_session, sizes):
    named = {f"s{i}" if i else None: n for i, n in enumerate(sizes)}
    frame = spark_session.createDataFrame(list(named.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(frame).collect()}
    for source, target in plain_targets(named).items():
        assert math.isclose(found[source], target, abs_tol=1e-6)


@pytest.fixture(scope="module")
def spark_session(spark):
    return spark


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_mix(given):
    sums = {}
    for r in given:
        sums[r[3]] = sums.get(r[3], 0) + size(r[1])
    target, out = plain_targets(sums), []
    for source in sums:
        keyed = []
        for r in (r for r in given if r[3] == source):
            own = "mix" if r[0] is None else f"mix|{r[0]}"
            u = (int(hashlib.md5(own.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            symbols = len(re.findall(mixing.SYMBOLS, r[1] or ""))
            quality = 1 / (1 + symbols / max(size(r[1]), 1))
            keyed.append((-math.log(u) / quality, key(r[0]), size(r[1]), r))
        epochs = math.floor(target[source] / sums[source]) if sums[source] else 0
        left = math.floor(target[source] - epochs * sums[source] + 0.5)
        for _, _, n, r in sorted(keyed, key=lambda k: k[:3]):
            part = max(0, min(n, left))
            left -= part
            out.append((r[0], n, sums[source], epochs * n + part))
    return out


def test_mix(docs, empty):  # noqa: F811
    found = mixing.digest(docs).collect()
    got = sorted(((r.doc_id, r["size"], r.source_size, r.taken) for r in found), key=lambda r: [key(x) for x in r])
    assert got == sorted(plain_mix(rows()), key=lambda r: [key(x) for x in r])
    again = mixing.digest(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert mixing.digest(empty).count() == 0


def test_mixture_has_the_words_taken(docs, empty):  # noqa: F811
    found = mixing.mixture(docs)
    assert found.columns == docs.columns and mixing.mixture(empty).count() == 0
    words = {}
    for r in found.collect():
        words[r.doc_id, r.source] = words.get((r.doc_id, r.source), 0) + size(r.text)
        assert r.n_chars == (None if r.text is None else len(r.text))
    expected = {}
    for r in mixing.mix(docs).collect():
        expected[r.doc_id, r.source] = expected.get((r.doc_id, r.source), 0) + r.taken
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in expected.items() if v}


def test_plan_is_native_and_whole_sources_never_meet(docs):  # noqa: F811
    from conftest import plan_of

    plan = plan_of(mixing.digest(docs))
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_borders_in_crowds(spark):
    """Null ids share one key, equal texts all of the order, and many digits push keys together at the far end."""
    texts = ["a b c", "d e", "f", "1 2 3 4 5 6 77777777", "88888888888888 9", "", None]
    given = [(None, texts[i % 7], "s") for i in range(300)] + [(None, "a b c", None)] * 200 + [(i, "9" * (i % 40) + " 1", "t") for i in range(400)]
    frame = spark.createDataFrame([(i, t, "en", s) for i, t, s in given], "doc_id long, text string, lang string, source string").repartition(4)
    found = mixing.digest(frame).collect()
    got = sorted(((r.doc_id, r["size"], r.source_size, r.taken) for r in found), key=lambda r: [key(x) for x in r])
    plain = plain_mix([(i, t, "en", s) for i, t, s in given])
    assert got == sorted(plain, key=lambda r: [key(x) for x in r])


def test_columns_of_every_name_stay(spark):
    frame = spark.createDataFrame([(1, "a b", "s", 1, 2, {"k": 3}, "x")], "doc_id long, text string, source string, _key int, _row int, _n map<string,int>, part string")
    row = mixing.mix(frame).first()
    assert (row._key, row._row, row._n, row.part) == (1, 2, {"k": 3}, 1)


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    expected = sorted(con.execute(mixing.SQL).fetchall())
    found = mixing.digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert sorted(map(tuple, found.collect())) == expected


def test_texts_without_words_come_with_whole_epochs(spark):
    """A lone source is taken once and a half; of three equal ones the last gets less than its size, and leaves them out."""
    data = [(1, "a b c d", "x"), (2, None, "x"), (2, None, "x"), (3, " \n", "x"), (4, "e f", None)]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string")
    one = frame.filter("source = 'x'")
    assert sorted(r.doc_id for r in mixing.mixture(one).collect() if r.doc_id != 1) == [2, 2, 3]
    taken = {r.doc_id: (r.size, r.epochs, r.taken) for r in mixing.mix(one).collect()}
    assert taken == {1: (4, 1, 6), 2: (0, 1, 0), 3: (0, 1, 0)}
    three = [(i, "f " * 100, s) for i, s in enumerate("xyz")] + [(3, None, "y"), (4, None, "z")]
    found = Counter(r.doc_id for r in mixing.mixture(spark.createDataFrame(three, frame.schema)).collect())
    assert (found[0], found[1], found[2], found[3], found[4]) == (2, 2, 1, 1, 0)
