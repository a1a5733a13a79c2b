import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpus import docs, empty, rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapstar.llm import packing


def plain_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 70))
@settings(max_examples=200, deadline=None)
def test_best_fit_is_best_fit(lengths, capacity):
    placed, seen = defaultdict(list), Counter()
    for length, first, last, sequence, each, offset in packing.best_fit(Counter(lengths), capacity):
        for k in range(last - first + 1):
            placed[sequence + k // each].append((offset + k % each * length, length))
            seen[length] += 1
    assert seen == Counter(lengths)
    rooms = []
    for row in placed.values():
        at = 0
        for offset, length in sorted(row):
            assert offset == at
            at += length
        rooms.append(capacity - at)
    assert sorted(rooms) == plain_best_fit(lengths, capacity)


def test_best_fit_refuses_what_is_too_long():
    with pytest.raises(ValueError):
        packing.best_fit({9: 1}, 8)


HARD = [
    "", "it's they'll I'M 'S don''t", "a.b,c;d:e!f?g", "end.. of!? \"it\"...", "<|endoftext|> <|ENDOFTEXT|>.x <|startoftext|>a.",
    "ÉTÉ. é́ é. J̌. İstanbul, ΣΊΣΥΦΟΣ. ΟΔΟΣ.", "3.14 1,000 v2.0 ⅔ ²", "a b c\u0085d\x1ce\x0bf", "日本語。テキスト, ok.",
    "x" * 500 + ".", "😀😀. ok😀.", "́ a", "naïve!naïve", "ﬁn. ŉ. K. Å", "​.a‍ b﻿.", "aͅ. ᾳ, ᾼ",
]


def plain_pieces(given, capacity):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for id, text in given:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out.append((id, k, start, len(part), zlib.crc32(part.tobytes())))
    return out


def check_packed(found, capacity):
    placed = defaultdict(list)
    for r in found:
        placed[r.sequence_id].append((r.offset, r.length))
    rooms = []
    for row in placed.values():
        at = 0
        for offset, length in sorted(row):
            assert offset == at
            at += length
        rooms.append(capacity - at)
    assert sorted(rooms) == plain_best_fit([r.length for r in found], capacity)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pieces_are_the_tokenizer_s(spark, docs, capacity):  # noqa: F811
    given = [(i, t) for i, t in enumerate(HARD)] + [(100 + i, r[1]) for i, r in enumerate(rows())]
    frame = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    pieces = packing.tokens(frame, capacity=capacity).withColumn("crc", F.crc32("ids")).drop("ids")
    found = packing.pack(pieces, capacity).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.crc) for r in found) == sorted(plain_pieces(given, capacity))
    check_packed(found, capacity)


def test_memory_and_probes(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    words = packing.Words(path)
    assert words.short
    monkeypatch.setattr(packing, "MEMORY", 0)
    forgetful = packing.Words(path)
    for word in " ".join(HARD).encode().split():
        assert forgetful[word] == words[word]
    assert not forgetful


def test_digest_of_hard_rows(spark, docs, empty):  # noqa: F811
    found = packing.digest(spark, docs).collect()
    assert len(found) == len(plain_pieces([(r[0], r[1]) for r in rows()], 2048))
    check_packed(found, 2048)
    assert packing.digest(spark, empty).count() == 0


def test_lengths_that_take_no_place(spark):
    frame = spark.createDataFrame([(1, 0, None), (2, 0, 0), (3, 0, 5), (3, 0, 5)], "doc_id long, piece int, length long")
    found = packing.pack(frame.withColumn("offset", F.lit("clash")), 8).collect()
    assert sorted((r.doc_id, r.offset) for r in found if r.sequence_id is not None) == [(3, 0), (3, 0)]
    assert sorted(r.doc_id for r in found if r.sequence_id is None) == [1, 2]


def test_documents_keep_their_ids(spark, docs):  # noqa: F811
    found = packing.pack_documents(docs.filter("doc_id in (1, 7)")).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for id, text in [(r[0], r[1]) for r in rows() if r[0] in (1, 7)]:
        own = sorted((r.piece, bytes(r.ids)) for r in found if r.doc_id == id)
        assert np.frombuffer(b"".join(x for _, x in own), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]
