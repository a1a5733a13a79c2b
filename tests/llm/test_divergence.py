import random
import re
from collections import Counter, defaultdict

import pytest
from corpus import docs, empty, rows  # noqa: F401
from pyspark.sql import functions as F

from snapstar.llm import divergence

SCHEMA = "text string, lang string, source string"


def words(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(documents, least=30, top=50):
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in documents:
        counts[lang or "", source or ""].update(words(text))
        held[lang or ""].update(set(words(text)))
    found = []
    for lang in held:
        kept = [t for t, n in held[lang].items() if n >= least]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        whole = sum(groups.values(), Counter())

        def shares(counter):
            size = sum(counter[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counter[t] + 5) // size for t in kept}  # noqa: B023

        q, p = shares(whole), {s: shares(c) for s, c in groups.items()}
        for s in groups:
            apart = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            found += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(apart))]
            ahead = [(q[t] - p[s][t], t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            found += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(ahead)[:top])]
    return Counter(found)


def made(seed, n=300):
    rand = random.Random(seed)
    vocabulary = ["Fox", "é", "ÀB", "\U0001f600x", "￮y", "the", "THE", "a1b"] + [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    texts = [" ".join(rand.choices(vocabulary, weights=range(1, len(vocabulary) + 1), k=rand.randint(0, 9))) for _ in range(n)]
    return [(t, rand.choice(["en", "en", "de", None, ""]), rand.choice(["a", "b", "ü", "￮z", "\U0001f600", None])) for t in texts]


def found_in(frame, **options):
    return Counter(tuple(r) for r in divergence.audit(frame, **options).collect())


@pytest.mark.parametrize("seed, least, top, sources", [(1, 3, 50, 256), (2, 12, 2, 2), (3, 1, 4, 1)])
def test_against_plain(spark, seed, least, top, sources, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", sources)
    given = made(seed) + [(None, "fr", "a"), ("", "fr", "b"), ("!", "fr", None), ("one", "xx", "lonely")]
    frame = spark.createDataFrame(given, SCHEMA).repartition(3)
    assert found_in(frame, least=least, top=top) == plain(given, least, top)


def test_blocks_in_parts():
    """A block of sources adds its terms up in as many parts as it likes."""
    rand, n = random.Random(5), 7
    none = [rand.randint(1, 9) for _ in range(n)]
    some = [(f"t{t}", p, rand.randint(10, 99)) for t in range(40) for p in rand.sample(range(n), 3)]
    sums = []
    for size in (n, 3 * n, 1 << 20):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(divergence, "VALUES", size)
            block = divergence._Block("en", 0, 0)
            for p in range(n):
                block.add(None, p, none[p])
            for row in some:
                block.add(*row)
            sums.append(block.sums().to_pylist())
    table = {t: {p: v for x, p, v in some if x == t} for t, _, _ in some}
    expected = {(a, b): sum(abs(r.get(a, none[a]) - r.get(b, none[b])) for r in table.values()) for a in range(n) for b in range(a + 1, n)}
    assert sums[0] == sums[1] == sums[2] and {(r["place"], r["other"]): r["value"] for r in sums[0]} == expected


def test_counts_beyond_64_bits(spark):
    counts = [(10**18, 3 * 10**18, 7), (0, 10**13, 10**6), (5, 0, 1)]
    found = spark.createDataFrame(counts, "n long, size long, kept long").select("*", divergence.share(F.col("n"), F.col("size"), F.col("kept")).alias("p"))
    for r in found.collect():
        assert r.p == 1 + 10**9 * (r.n + 5) // (r.size + 5 * r.kept)


def test_hard_rows(docs, empty):  # noqa: F811
    given = [r[1:4] for r in rows()]
    clashing = docs.withColumns({c: F.lit("clash") for c in ("n", "term", "total", "item", "place", "value")})
    assert found_in(clashing, least=1) == plain(given, 1)
    assert found_in(docs) == plain(given) and found_in(empty) == Counter()


def test_sent_early(spark, monkeypatch):
    """Counts that a task sends before its end are added up like any others."""
    given = made(9)
    batch = spark.createDataFrame(given, SCHEMA).fillna("").select("lang", "source", "text").toArrow().to_batches(max_chunksize=20)
    whole = Counter()
    for size in (1 << 20, 10):
        monkeypatch.setattr(divergence, "HELD", size)
        sent = Counter()
        for part in divergence._count(iter(batch)):
            for r in part.to_pylist():
                sent[r["lang"], r["source"], r["term"], "n"] += r["n"]
                sent[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        assert not whole or sent == whole
        whole = sent
