import numpy as np
import public_tokenizers
from corpus import docs, empty, rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snapstar.llm import token_counts


def plain(text, encoding):
    """Token by token and section by section."""
    data, at, spans = (text or "").encode(), 0, []
    for token in encoding.encode_ordinary(text or ""):
        size = len(encoding.decode_single_token_bytes(token))
        spans.append((at, at + size))
        at += size
    assert at == len(data)
    stops = [i + 1 for i, b in enumerate(data) if b == 10]
    if not stops or stops[-1] < len(data):
        stops.append(len(data))
    sections = list(zip([0, *stops[:-1]], stops, strict=True))
    counts, crossing = [0] * len(sections), [0] * len(sections)
    for a, b in spans:
        shares = [min(b, y) - max(a, x) for x, y in sections]
        best = max(range(len(sections)), key=lambda i: (shares[i], -i))
        counts[best] += 1
        crossing[best] += sum(s > 0 for s in shares) > 1
    return [(i, x, y - x, n, c) for i, ((x, y), n, c) in enumerate(zip(sections, counts, crossing, strict=True))]


SPANS = token_counts.Spans()


@given(st.lists(st.text(alphabet="ab é\n\n😀. 1", max_size=50), min_size=1, max_size=20))
@settings(max_examples=10, deadline=None)
def test_sections(one_session, texts):
    frame = one_session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in token_counts.count_tokens(frame).collect():
        found.setdefault(r.doc_id, []).append((r.section, r.start, r.n_bytes, r.n_tokens, r.n_crossing))
    assert {k: sorted(v) for k, v in found.items()} == {i: plain(t, SPANS.encoding) for i, t in enumerate(texts)}


import pytest  # noqa: E402


@pytest.fixture(scope="module")
def one_session(spark):
    return spark


def test_rule_for_borders():
    ends = np.array([2, 5, 9, 10])
    starts, stops = np.array([0, 3, 7]), np.array([3, 7, 10])
    # [2, 5) has 1 byte in the first and 2 in the second; [5, 9) has 2 and 2: the earlier one.
    tokens, crossing = token_counts.attribute(ends, starts, stops)
    assert tokens.tolist() == [1, 2, 1] and crossing.tolist() == [0, 2, 0]
    wide, over = token_counts.attribute(np.array([10]), starts, stops)
    assert wide.tolist() == [0, 1, 0] and over.tolist() == [0, 1, 0]


def test_parts_of_long_texts(monkeypatch):
    text = " ".join(f"word{i}, \n\n Éa {'a' * (i % 40)}  x" for i in range(3000))
    whole = SPANS.ends(text.encode())
    monkeypatch.setattr(token_counts, "PART", 700)
    assert np.array_equal(SPANS.ends(text.encode()), whole) and len(list(token_counts._parts(text.encode()))) > 50


def test_table_counts_equal_another_library(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    expected = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) for r in table.collect()}
    found = token_counts.totals(token_counts.count_tokens(table)).collect()
    assert {r.doc_id: r.n_tokens for r in found} == expected


def test_hard_rows(docs, empty):  # noqa: F811
    found = token_counts.count_tokens(docs).collect()
    assert len(found) == sum(len(plain(r[1], SPANS.encoding)) if r[0] != 7 else 1 for r in rows())
    assert [(r.section, r.n_bytes, r.n_tokens) for r in found if r.doc_id in (4, 5)] == [(0, 0, 0)] * 2
    assert token_counts.count_tokens(empty).count() == 0
