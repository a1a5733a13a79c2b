import hashlib
import random
import re
import time

import pytest
from corpus import docs, empty, rows  # noqa: F401
from pyspark.sql import functions as F

from snapstar.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def passes(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [
        (kind, *m.span()) for kind, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(kind, m.group())
    ]


def base_of(row):
    return [(s.kind, s.start, s.end) for s in row.spans if s.base]


def noisy(rand):
    alphabet = "a@.b+-_%1 2()0é😀\n9"
    parts = ["a.b@c.de", "_x@y.z", "1.2.3.4", "300.1.1.1", "010.0.00.255", "4111 1111 1111 1111", "4111-1111-1111-1112"]
    parts += ["+1 (555) 123-4567", "+49", "5500005555555559", "@", "..", "a@b", "x@y.z.w_q@r.st"]
    return "".join(rand.choice(parts) if rand.random() < 0.3 else rand.choice(alphabet) for _ in range(rand.randint(0, 60)))


def test_base_spans_of_noise(spark):
    rand = random.Random(5)
    texts = [noisy(rand) for _ in range(1500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(frame).collect():
        assert base_of(r) == plain(texts[r.doc_id]), repr(texts[r.doc_id])


def test_long_runs_and_many_spans(spark):
    texts = ["a" * 60_000 + "@", "1" * 60_000, "1." * 30_000, "1 " * 30_000, "+1" + "()" * 30_000, "é 1.2.3.4 x@y.zz, " * 1500]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: base_of(r) for r in pii.find(frame).collect()}
    assert found[5] == plain(texts[5]) and len(found[5]) == 3000
    for i in range(5):
        assert found[i] == ([] if i != 2 else plain(texts[2]))


def test_context_is_what_stands_beside(spark):
    """The pieces between matches give the same characters as the text itself."""
    rand = random.Random(6)
    texts = [noisy(rand) * rand.choice([1, 3]) for _ in range(300)] + ["1 1," * 40, "a@b.c" * 30, "x " * 40 + "1.2.3.4"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = frame.select("doc_id", *[pii.matches(F.col("text"), k).alias(k) for k in pii.PATTERNS]).collect()
    seen = 0
    for r in found:
        text = texts[r.doc_id]
        for m in (m for k in pii.PATTERNS for m in r[k]):
            seen += 1
            assert (m.hit, m.before, m.after) == (text[m.start : m.end], text[max(0, m.start - pii.CONTEXT) : m.start], text[m.end : m.end + 1])
    assert seen > 500


def test_keys_and_names_beside_base_spans(spark):
    """What overlaps a valid base span is left out, whatever the order; the rest stays."""
    rand = random.Random(8)
    parts = ["a1b2c3d4e5f6g7h8i9", "x@y.zz", "4111111111111111", "Mr Smith", "Mr Jones@x.yz", "k1234567890abcdef.q@z.com", "4111111111111111a", " ", ",", "é"]
    texts = ["".join(rand.choice(parts) for _ in range(rand.randint(0, 14))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    every = frame.select("doc_id", *[pii.matches(F.col("text"), k).alias(k) for k in ("key", "name")])
    listed = {r.doc_id: [(m.kind, m.start, m.end) for k in ("key", "name") for m in r[k]] for r in every.collect()}
    for r in pii.candidates(frame).collect():
        base = [(x.start, x.end) for x in r.candidates if x.base]
        expected = [x for x in listed[r.doc_id] if not any(a < x[2] and x[1] < b for a, b in base)]
        assert [(x.kind, x.start, x.end) for x in r.candidates if x.kind in ("key", "name")] == expected


def test_time_grows_with_the_spans(spark):
    """Twenty thousand spans in one document: four times the spans take about four times as long, not sixteen."""
    seconds = []
    for n in (5_000, 20_000):
        text = "".join(f"é mail user{i}@mail.com key sk_ab{i}cdefghijk123456, " for i in range(n // 2))
        frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
        planned = pii.candidates(frame)
        spans = F.array_sort(pii._placed(F.filter("candidates", lambda x: x["base"] | (x["kind"] == "key")))).alias("s")
        whole = planned.select("text", spans).select(pii._covered(F.col("text"), F.col("s")).alias("t"), F.size("s").alias("n"))
        whole.limit(0).collect()
        start = time.perf_counter()
        (row,) = whole.collect()
        seconds.append(time.perf_counter() - start)
        assert row.n == n and row.t.count("[EMAIL]") == row.t.count("[KEY]") == n // 2 and "@" not in row.t
    assert seconds[1] < 30 and seconds[1] < 9 * seconds[0] + 2, seconds


def test_table_digest(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    for r in pii.digest(table).collect():
        base = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in PLAIN]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_model_adds_what_labelers_agree_on(spark):
    texts = [f"my mail is user{i}@mail.com and card 4111 1111 1111 1111" for i in range(60)]
    texts += [f"password: AKIA{i:02d}ABCDEFGH1234XY ok" for i in range(60)]
    texts += [f"Dear Mr. Smith{'abcdefgh'[i % 8]}, hello" for i in range(60)]
    texts += [f"version 999.888.777.{i} build 1111111111111111{i}" for i in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: {s.kind for s in r.spans} for r in pii.find(frame).collect()}
    assert all(found[i] == {"email", "card"} for i in range(60))
    assert all(found[i] == {"key"} for i in range(60, 120))
    assert not any("ip" in found[i] for i in range(180, 240))


def test_reliabilities_follow_the_majority():
    def row(kind, *votes):
        return dict(zip(("kind", *pii.VOTERS), (kind, *votes), strict=True))

    data = [(row("ip", 1, 1, 0, 1), 500), (row("ip", -1, -1, 0, -1), 500), (row("ip", 1, 1, 0, -1), 20), (row("ip", -1, -1, 1, 1), 9)]
    truth = pii.reliabilities(data)
    assert truth[0] > 0.95 and truth[1] < 0.05 and truth[2] > 0.5


def plain_redact(text, spans):
    out, at = "", 0
    for start, end, kind in sorted((s.start, s.end, s.kind) for s in spans):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_redact(spark, docs, empty):  # noqa: F811
    texts = ["x 10.20.30.40 y é a@b.cd", "+1 4111111111111111 z", "nothing", None, "", "+12345678 4111 1111 1111 1111"]
    frame = spark.createDataFrame([(i, t, None if t is None else len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    spans = {r.doc_id: r.spans for r in pii.find(frame).collect()}
    for r in pii.redact(frame).collect():
        expected = None if texts[r.doc_id] is None else plain_redact(texts[r.doc_id], spans[r.doc_id])
        assert r.text == expected and r.n_chars == (None if expected is None else len(expected))
    assert pii.redact(docs).columns == docs.columns and pii.redact(docs).count() == len(rows())
    assert pii.redact(empty).count() == 0


def test_hard_rows(docs, empty):  # noqa: F811
    assert pii.digest(docs).count() == len(rows()) and pii.digest(empty).count() == 0
    assert pii.digest(docs.withColumn("candidates", F.lit(1))).filter("spans != ''").count() == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_running_maximum(spark, n):
    given = [(i * 7919) % 1009 - 500 for i in range(n)]
    frame = spark.createDataFrame([(given,)], "a array<long>")
    (row,) = frame.select(pii.running(F.col("a"), F.greatest).alias("m")).collect()
    assert row.m == [max(given[: i + 1]) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_running(spark, n):
    (row,) = spark.range(1).select(pii.running(F.expr(f"slice(sequence(1L, {n + 1}L), 1, {n})")).alias("s")).collect()
    assert row.s == [i * (i + 1) // 2 for i in range(1, n + 1)]


def test_plan_is_native(docs):  # noqa: F811
    from conftest import plan_of

    for frame in (pii.candidates(docs), pii.digest(docs)):
        plan = plan_of(frame)
        assert "Python" not in plan and "MapInArrow" not in plan and "Join" not in plan


def test_long_secrets(spark):
    """A key of more than 128 letters and digits is found whole."""
    keys = ["sk_" + "aB3dE6gH9" * k for k in (10, 14, 15, 40)] + ["x1" * 100_000]
    frame = spark.createDataFrame([(i, f"the token is {k}, keep it") for i, k in enumerate(keys)], "doc_id long, text string")
    found = {r.doc_id: [s.hit for s in r.found] for r in frame.select("doc_id", pii.matches(F.col("text"), "key").alias("found")).collect()}
    assert found == {i: [k] for i, k in enumerate(keys)}
