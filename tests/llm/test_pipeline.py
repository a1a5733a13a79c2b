"""The pipeline's stages against plain versions, each on what the one before it returned."""

from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from corpus import docs, empty, rows  # noqa: F401
from test_mixing import plain_mix, size
from test_packing import check_packed, plain_pieces
from test_pii import plain_redact
from test_simhash import classes, plain

import __spark_entry__ as entry
from snapstar.llm import pii, simhash
from snapstar.session import stored


@pytest.fixture(scope="module")
def passed(spark):
    sf_dir = "/root/testdata/sf0.001"
    frames = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], sf_dir), "stage"))
    return frames


def test_stages_return_documents(passed):
    for frame in passed[1:-1]:
        assert frame.schema.simpleString() == passed[0].schema.simpleString()


def test_language_keeps_every_text_with_letters(passed):
    expected = sorted(r.doc_id for r in passed[0].collect() if any(c.isalpha() for c in r.text or ""))
    assert sorted(r.doc_id for r in passed[1].collect()) == expected


def test_one_of_each_group_stays(passed):
    given = passed[1].collect()
    of = classes([plain(r.text) for r in given])
    least = {}
    for r, c in zip(given, of, strict=True):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in passed[2].collect()) == sorted(least.values())


def test_personal_data_is_covered(passed):
    spans = {r.doc_id: r.spans for r in pii.find(passed[2]).collect()}
    expected = {r.doc_id: plain_redact(r.text, spans[r.doc_id]) for r in passed[2].collect()}
    found = passed[3].collect()
    assert {r.doc_id: r.text for r in found} == expected and all(r.n_chars == len(r.text) for r in found)


def test_mix_has_the_words_it_takes(passed):
    expected = Counter()
    for id, _, _, taken in plain_mix([tuple(r) for r in passed[3].collect()]):
        expected[id] += taken
    found = Counter()
    for r in passed[4].collect():
        found[r.doc_id] += size(r.text)
    assert +found == +expected


def test_packed_pieces(passed):
    found = passed[5].collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(
        plain_pieces([(r.doc_id, r.text) for r in passed[4].collect()], 2048)
    )
    check_packed(found, 2048)


def test_run_and_registry(spark, passed):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = entry.queries()["pipeline"](spark, "/root/testdata/sf0.001")
    assert sorted(run.select(names).collect()) == sorted(passed[5].select(names).collect())
    ops = [n for n in entry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in ops] == list(range(1, 14))
    assert {"op6_mixing", "op11_lexical", "op12_divergence"} <= set(entry.oracle_sql())


def test_nothing_unredacted_is_left(spark, monkeypatch):
    """Of a run the mixed documents are left, and what the packing has stored; of a run that breaks off, nothing before its stage."""
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {*shared.iterdir()}
    corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = {p.name.rpartition("-")[0] for p in {*shared.iterdir()} - before}
    assert "mixing" in left and not left & {"language", "near-duplicates", "personal-data", "pii-rows", "simhash-rows"}

    def broken(spark, docs, sf_dir):
        stored(docs, "unredacted")
        raise ValueError

    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[:2], ("personal data", broken), *corpus_pipeline.STAGES[3:]])
    before = {*shared.iterdir()}
    with pytest.raises(ValueError):
        corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {*shared.iterdir()} == before


def test_hard_rows_pass_through(spark, docs, empty):  # noqa: F811
    for frame in (docs, empty):
        given = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            given = stored(stage(spark, given, ""), "stage")
            assert given.columns == frame.columns
        assert (corpus_pipeline.pack(spark, given, "").count() > 0) == (frame is docs)
    assert simhash.deduplicate(docs).filter("doc_id in (1, 2) and lang = 'en'").count() == 1
