import hashlib

import pytest
from corpus import docs, empty, rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from snapstar.llm.fingerprints import PrefixHash, digest, likeness, neighbours

texts = st.text(alphabet="abñ😀 ", max_size=60)


@given(texts, texts)
@settings(max_examples=150, deadline=None)
def test_spans_and_extensions(a, b):
    one, other = PrefixHash(a), PrefixHash(b)
    for i in range(0, len(a), 3):
        for j in range(0, len(b), 3):
            plain = 0
            while i + plain < len(a) and j + plain < len(b) and a[i + plain] == b[j + plain]:
                plain += 1
            assert one.extension(i, other, j) == plain
    if len(a) > 3:
        assert (one.span(0, 2) == one.span(2, 4)) == (a[:2] == a[2:4])
        found = one.spans(2).tolist()
        assert [x == found[0] for x in found] == [a[i : i + 2] == a[:2] for i in range(len(a) - 1)]


def test_likeness():
    words = [f"word{i}" for i in range(400)]
    whole, half = " ".join(words), " ".join(words[:200] + [f"other{i}" for i in range(200)])
    a, b = PrefixHash(whole).fingerprint(), PrefixHash(half).fingerprint()
    assert likeness(a, a) == 1 and 0.3 < likeness(a, b) < 0.7
    assert likeness(a, PrefixHash("nothing of the kind " * 9).fingerprint()) < 0.1
    assert likeness(PrefixHash("").fingerprint(), a) == 0 and likeness(*[PrefixHash("").fingerprint()] * 2) == 1


def expected(given):
    def place(r):
        return (r[0] is None, -(r[0] or 0))

    ordered = sorted(given, key=place)
    out = []
    for own, after in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        a, b = own[1] or "", after[1] or ""
        half = len(a) // 2
        edited = a[: len(a) - half] + b[:half]
        out.append((own[0], len(a), hashlib.sha256(edited.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_neighbours(spark, docs, parts):  # noqa: F811
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        unique = [r for r in rows() if r[0] not in (2, 3, None)]  # ties are interchangeable
        some = docs.filter("doc_id is not null and doc_id not in (2, 3)")
        found = digest(some).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == sorted(expected(unique))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_ties_nulls_and_one_row(docs, empty):  # noqa: F811
    found = neighbours(docs).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows())
    marks = {}
    for r in found:
        marks.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert marks[1, len(rows()[0][1])] <= marks[2, len(rows()[0][1])]  # equal texts, equal fingerprints
    assert neighbours(empty).count() == 0
    (alone,) = digest(docs.filter("doc_id = 1")).collect()
    text = rows()[0][1]
    assert alone.edited_sha256 == hashlib.sha256((text[: len(text) - len(text) // 2] + text[: len(text) // 2]).encode()).hexdigest()
    assert alone.near_next == 1 and alone.same_as_next == len(text)
