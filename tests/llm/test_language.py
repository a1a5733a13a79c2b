import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus import DE, EN, ES, FR, docs, empty, rows  # noqa: F401
from pyspark.sql import functions as F

from snapstar.llm import language


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(table):
    found = language.digest(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    unseen = [r for r in found if r.held_out]
    assert len(unseen) > 200 and all(0 <= r.score <= 1 for r in found)
    assert sum(r.lang == r.lang_pred for r in unseen) / len(unseen) > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)


def test_hard_rows(docs, empty):  # noqa: F811
    found = language.digest(docs).collect()
    assert len(found) == len(rows())
    by_id = {r.doc_id: r for r in found}
    for id in (4, 5, 6, 9):  # null, empty, blank, no letter
        assert by_id[id].lang_pred == "und" and by_id[id].score == 0
    assert by_id[8].lang_pred != "und"  # one letter
    assert not any(r.held_out for r in found if r.doc_id is None)
    assert language.digest(empty).count() == 0


def test_nothing_to_learn_from(docs):  # noqa: F811
    model = language.fit(docs.filter("lang is null"))
    assert {(r.lang_pred, r.score) for r in language.predict(docs, model).collect()} == {("und", 0.0)}


def test_one_language_and_many():
    texts = {"en": EN, "de": DE, "fr": FR, "es": ES}
    data = [(lang, " ".join(text.split()[i : i + 7])) for lang, text in texts.items() for i in range(8)]
    features = language.features(pa.array([t for _, t in data]))
    model = language.Model(features, [lang for lang, _ in data])
    assert model.families == ["germanic", "romance"] and [len(p) for p in model.pairs] == [1, 1]
    assert (model.predict(features)[0] == [lang for lang, _ in data]).mean() > 0.95
    alone = language.Model(features[:8], ["en"] * 8)
    assert set(alone.predict(features)[0]) == {"en"}
    three = language.Model(features[:24], [lang for lang, _ in data[:16]] + ["nl"] * 8)
    assert len(three.pairs[0]) == 3 and set(three.predict(features[:16])[0]) <= {"en", "de", "nl"}


def test_features_of_a_slice():
    texts = pa.array(["one", None, "", "three four", "ÉTÉ"])
    whole = language.features(texts)
    assert np.array_equal(whole[2:], language.features(texts.slice(2)))
    assert np.array_equal(whole[4], language.features(pa.array(["été"]))[0])


def test_columns_are_kept(docs):  # noqa: F811
    found = language.predict(docs, language.fit(docs))
    assert found.columns == [c for c in docs.columns if c != "lang_pred"] + ["lang_pred", "score"]
    assert found.filter("size = 'clash'").count() == len(rows())


def plain_features(text):
    """Bucket to value: byte trigrams of the lower-cased text between two spaces, roots of counts, length 1."""
    data = f" {text or ''} ".lower().encode()
    bits = language.SIZE.bit_length() - 1
    counts = Counter((int.from_bytes(data[i : i + 3], "big") * 0x9E3779B1 % 2**32) >> (32 - bits) for i in range(len(data) - 2))
    length = math.sqrt(sum(counts.values()))
    return {k: math.sqrt(n) / length for k, n in counts.items()}


def plain_margin(weights, values):
    return float(weights[-1]) + sum(float(weights[k]) * v for k, v in values.items())


def plain_predict(model, text):
    """The family of the greatest margin; within it, the language that most of its pairs vote for."""

    def chance(margin):
        return 1 / (1 + math.exp(-3 * max(-20, min(20, margin))))

    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    values = plain_features(text)
    outer = [plain_margin(w, values) for w in model.outer]
    f = max(range(len(outer)), key=outer.__getitem__)
    own, sure = model.within[f], chance(outer[f])
    margins = {pair: plain_margin(w, values) for pair, w in zip(model.pairs[f], model.inner[f], strict=True)}
    toward = {x: [m if a == x else -m for (a, b), m in margins.items() if x in (a, b)] for x in range(len(own))}
    best = max(toward, key=lambda x: (sum(m > 0 for m in toward[x]), sum(map(chance, toward[x]))))
    return own[best], sure * (sum(map(chance, toward[best])) / len(toward[best]) if toward[best] else 1)


def test_prediction_against_a_plain_version(table):
    """Each whole text of a table, with the weights that were learnt; features, steps and votes are found anew."""
    model = language.fit(table.filter(~language.held_out()))
    assert len(model.families) > 1 and any(model.pairs)
    texts = {r.doc_id: r.text for r in table.collect()}
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(table.select("doc_id", "text"), model).collect()}
    assert found.keys() == texts.keys()
    for id, text in texts.items():
        lang, score = plain_predict(model, text)
        assert found[id][0] == lang and math.isclose(found[id][1], score, abs_tol=1e-4), id


def test_three_languages_of_a_family_against_a_plain_version():
    parts = {"en": EN, "de": DE, "nl": "de kat zit op een stoel en kijkt naar buiten terwijl het regent in de stad " * 4, "fr": FR}
    data = [(lang, " ".join(text.split()[i : i + 6])) for lang, text in parts.items() for i in range(12)]
    model = language.Model(language.features(pa.array([t for _, t in data])), [lang for lang, _ in data])
    assert [len(p) for p in model.pairs] == [3, 0]
    texts = [t for _, t in data] + ["the stoel und", "le kat chien", "a"]
    langs, scores = model.predict(language.features(pa.array(texts)))
    for text, lang, score in zip(texts, langs, scores, strict=True):
        assert lang == plain_predict(model, text)[0] and math.isclose(score, plain_predict(model, text)[1], abs_tol=1e-4)


def test_machine_against_another_solver():
    """The dual problem of a small set by projected gradient: the value of the primal problem is at most 2% above the best."""
    rand = np.random.default_rng(3)
    rows = rand.normal(size=(60, 6)).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    positive = rows @ rand.normal(size=6) + rand.normal(size=60) * 0.2 > 0
    x, y = np.hstack([rows, np.ones((60, 1))]).astype(float), np.where(positive, 1.0, -1.0)
    kernel = (x * y[:, None]) @ (x * y[:, None]).T
    step, alpha = 1 / np.linalg.norm(kernel, 2), np.zeros(60)
    for _ in range(200_000):
        alpha = np.clip(alpha - step * (kernel @ alpha - 1), 0, language.PENALTY)

    def primal(w):
        return w @ w / 2 + language.PENALTY * np.maximum(0, 1 - y * (x @ w)).sum()

    best = primal(x.T @ (alpha * y))
    assert best <= primal(language.machine(rows, positive).astype(float)) * (1 + 1e-9)
    assert primal(language.machine(rows, positive).astype(float)) < best * 1.02


def test_held_out_rows_teach_nothing(table):
    before = {tuple(r) for r in language.digest(table).select("doc_id", "lang_pred", "score").collect()}
    wrong = table.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert {tuple(r) for r in language.digest(wrong).select("doc_id", "lang_pred", "score").collect()} == before
