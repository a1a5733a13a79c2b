import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import DE, EN, docs, empty, rows  # noqa: F401
from pyspark.sql import functions as F

from snapstar.llm import lexical

ITEMS = "item_id long, text string, doc_id string, rank string, score string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(documents, items, top=20):
    """Every document scored for every item."""
    bags = [(id, Counter(words(text))) for id, text in documents]
    bags = [(id, b, b.total()) for id, b in bags if b]
    total, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = defaultdict(list)
    for id, text in items:
        asked[id] += words(text)
    found = []
    for item, terms in asked.items():
        ranked = []
        for id, bag, n in bags:
            m = 75 + 25 * n * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m)) for t in terms if bag[t]
            )
            if score > 0:
                ranked.append((-score, id is None, id or 0, id))
        found += [(item, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(ranked, key=lambda r: r[:3])[:top])]
    return found


def noisy(rand, n):
    vocabulary = ["fox", "Dog", "é1", "x", "the", "naïve", "42", "ÀB", "end", "z9"] + [f"w{i}" for i in range(40)]
    return rand.choice([" ", ", ", "-", "\n"]).join(rand.choice(vocabulary) for _ in range(rand.randint(0, n)))


def test_against_every_document(spark):
    rand = random.Random(3)
    documents = [(i, noisy(rand, 12)) for i in range(400)]
    documents += [(1000 - i, "fox the dog, fox") for i in range(300)] + [(i % 7, "The fox: dog? FOX!") for i in range(50)]
    items = [(i, noisy(rand, 8)) for i in range(60)] + [(7, "fox fox"), (99, "fox"), (None, "dog dog"), (None, "fox"), (98, "unseen"), (97, None), (96, "")]
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in items], ITEMS)
    expected = plain(documents, items)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for top, block, scores in ((20, 1 << 20, 1 << 20), (3, 200, 64)):
            whole = expected if top == 20 else plain(documents, items, 3)
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(lexical, "SCORES", scores)
                found = lexical.search(frame, asked, top, block=block, most=40).collect()
            assert Counter(map(tuple, found)) == Counter(whole)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_scores_in_slices(monkeypatch):
    rand = random.Random(4)
    items = lexical.items_of([(i, noisy(rand, 30) + " fox") for i in range(20)])
    bags = [np.array([sorted(rand.sample(range(len(items.index)), 9)), range(1, 10)], "<u4").tobytes() for _ in range(15)]
    weights, m = np.arange(len(items.index)) + 5, np.arange(15) + 80
    whole = lexical._scores(items, weights, m, bags)
    monkeypatch.setattr(lexical, "SCORES", 3)
    assert np.array_equal(lexical._scores(items, weights, m, bags), whole) and whole.any()


def test_hard_rows(spark, docs, empty):  # noqa: F811
    asked = [(1, EN), (2, DE), (3, None), (4, "word5 zorro"), (5, "12")]
    items = spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in asked], ITEMS)
    clashing = docs.withColumns({c: F.lit("clash") for c in ("n", "bag", "_id", "item", "rank")})
    found = lexical.search(clashing, items).collect()
    assert Counter(map(tuple, found)) == Counter(plain([r[:2] for r in rows()], asked))
    assert lexical.search(empty, items).count() == 0 and lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs, items.filter("item_id = 3")).count() == 0


def test_one_class_is_scored_once(spark, docs):  # noqa: F811
    """Copies share a class: however many, a task sends the first few, and the plan has no join."""
    from conftest import plan_of

    items = spark.createDataFrame([(1, EN)], "item_id long, text string")
    plan = plan_of(lexical.search(docs, items))
    assert "Join" not in plan and plan.count("WindowGroupLimit") == 4
