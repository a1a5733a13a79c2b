import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import docs, empty, rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapstar.llm import outliers


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


@given(st.lists(st.text(alphabet="ab \n\t #", max_size=60), min_size=1, max_size=12))
@settings(max_examples=10, deadline=None)
def test_base_statistics(one_session, texts):
    texts = [*texts, "a b c d e " * 3, "a a a a a a", "a b\n\na b\n \n \nx"]
    frame = one_session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: tuple(r[c] for c in BASE) for r in outliers.statistics(frame, ["doc_id"]).collect()}
    assert found == {i: plain(t) for i, t in enumerate(texts)}


@pytest.fixture(scope="module")
def one_session(spark):
    return spark


@pytest.fixture(scope="module")
def judged(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = outliers.judge(table, ["doc_id", "lang", "source"]).collect()
    return {r.doc_id: r.text for r in table.collect()}, found


def test_table(judged):
    texts, found = judged
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r[c] for c in BASE) == plain(texts[r.doc_id])
        assert r.kept == (not r.base_failed and r.distance <= outliers.CUTOFF)


def test_clean_documents_stay_and_junk_goes(spark, judged):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    clean = [r for r in judged[1] if labels.get(r.doc_id) == 1 and not r.base_failed]
    junk = [r for r in judged[1] if labels.get(r.doc_id) == 0]
    assert all(r.kept for r in clean) and not any(r.kept for r in junk)


def plain_distances(x, least=outliers.STATISTICS):
    """The same estimate with arrays."""
    floor = np.diag([v * v for v in least.values()])

    def middle(a, share):
        a = np.sort(a)
        return a[max(0, int(np.ceil(share * len(a))) - 1)]

    centre = np.array([middle(c, 0.5) for c in x.T])
    cov = np.diag([(1.4826 * middle(np.abs(c - m), 0.5)) ** 2 for c, m in zip(x.T, centre, strict=True)])
    for _ in range(outliers.STEPS + 1):
        d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov + floor), x - centre)
        last = d
        near = x[d <= middle(d, outliers.SUBSET)]
        centre, cov = near.mean(0), np.cov(near.T, bias=True)
    return last / max(1, middle(last, 0.5) / outliers.MEDIANS[len(least)])


def plain_vector(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars, symbols, dup, repeated, _ = plain(text)
    doubled = sum(a == b for a, b in zip(words, words[1:], strict=False))
    shares = [100 * symbols / (n + 30), 20 * dup / (len(lines) + 10), 20 * repeated / (n + 30), 20 * doubled / (n + 30)]
    return [math.log((chars + 6 * 30) / (n + 30)), *map(math.log1p, shares)]


def plain_judge(docs):
    """Distance and verdict of each (id, text, lang, source); a failure of the base rules has no distance."""
    found, members = {}, defaultdict(list)
    for id, text, lang, source in docs:
        if plain(text)[-1]:
            found[id] = (None, False)
        else:
            members[lang, source].append((id, plain_vector(text)))
    small = [one for own in members.values() if len(own) < outliers.LEAST_ROWS for one in own]
    for own in [small, *(own for own in members.values() if len(own) >= outliers.LEAST_ROWS)]:
        if own:
            far = plain_distances(np.array([v for _, v in own]), outliers.JUDGED)
            found |= {id: (d, bool(d <= outliers.CUTOFF)) for (id, _), d in zip(own, far, strict=True)}
    return found


def agree(frame, data):
    expected = plain_judge(data)
    found = {r.doc_id: (r.distance, r.kept) for r in outliers.judge(frame).collect()}
    assert found.keys() == expected.keys()
    for id, (distance, kept) in expected.items():
        assert found[id][1] == kept, id
        assert found[id][0] == distance or math.isclose(found[id][0], distance, rel_tol=1e-6, abs_tol=1e-9), id
    return expected


def test_verdict_against_arrays(spark):
    """Five statistics on a whole table; its groups are all small, so that three sources are taken as one to have larger ones."""
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    frame = frame.replace({"src1": "three", "src7": "three", "src11": "three"}, subset="source")
    data = [tuple(r) for r in frame.collect()]
    expected = agree(frame, data)
    sizes = Counter((lang, source) for id, _, lang, source in data if expected[id][0] is not None)
    assert min(sizes.values()) < outliers.LEAST_ROWS <= max(sizes.values())


def test_verdict_at_the_least_group(spark):
    """49 documents go to the common group, 50 have their own; a null language or source is a value of its own."""
    rand = np.random.default_rng(7)
    vocabulary = ["tree", "river", "of", "a", "stone", "morning", "walked", "under", "#", "blue"]
    groups = [("en", "web", 49), ("en", None, 50), (None, "web", 12), ("de", "web", 80)]
    data = []
    for lang, source, size in groups:
        for _ in range(size):
            n = int(rand.integers(12, 90))
            text = "\n".join(" ".join(rand.choice(vocabulary, 8)) for _ in range(n // 8 + 2))
            data.append((len(data), text, lang, source))
    data[3] = (3, "# % & | " * 2 + "one two three four five six seven eight nine $$$$$$ <<<<>>>>", "en", "web")
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    expected = agree(frame, data)
    assert sum(d is not None for d, _ in expected.values()) > 150 and not expected[3][1]


def test_distances_against_arrays(spark):
    rand = np.random.default_rng(0)
    x = rand.multivariate_normal([1, 2, 0, 1], np.diag([1, 2, 0.5, 3]) + 0.3, 200)
    x[:20] += 9
    names = list(outliers.STATISTICS)
    data = [("a" if i % 2 else "b", i, *map(float, v)) for i, v in enumerate(x)]
    frame = spark.createDataFrame(data, "group string, i long, " + ", ".join(f"{n} double" for n in names))
    found = {r.i: r.distance for r in outliers.distances(frame).collect()}
    for part in (0, 1):
        expected = plain_distances(x[part::2])
        assert np.allclose([found[i] for i in range(part, 200, 2)], expected, rtol=1e-6)
    assert min(found[i] for i in range(20)) > max(found[i] for i in range(20, 200))


def test_hard_rows(docs, empty):  # noqa: F811
    found = outliers.digest(docs).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows())
    assert {r.doc_id for r in found if not r.kept} >= {4, 5, 6, 8, 9, 12}
    assert outliers.digest(empty).count() == 0
    one = docs.filter("doc_id = 1").withColumn("n_words", F.lit("clash")).withColumn("group", F.lit(1))
    assert [r.kept for r in outliers.digest(one).collect()] == [True]


def test_plan_is_native(docs):  # noqa: F811
    from conftest import plan_of

    plan = plan_of(outliers.statistics(docs, ["doc_id"]))
    assert "Python" not in plan and "Arrow" not in plan and "Exchange RoundRobin" not in plan.replace("RoundRobinPartitioning(3)", "")


def test_labels_of_the_larger_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    found = outliers.digest(table).select("doc_id", "base_failed", "kept").collect()
    clean = [r.doc_id for r in found if labels.get(r.doc_id) == 1 and not r.base_failed and not r.kept]
    junk = [r.doc_id for r in found if labels.get(r.doc_id) == 0 and r.kept]
    assert (clean, junk) == ([], [])
