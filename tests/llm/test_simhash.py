import random

import numpy as np
import xxhash
from corpus import docs, empty, key, rows  # noqa: F401

from snapstar.llm import simhash
from snapstar.llm.common import components


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, distance=3):
    """The class number of each fingerprint, by comparing all pairs."""
    of = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance and of[i] != of[j]:
                low, high = sorted((of[i], of[j]))
                of = [low if x == high else x for x in of]
    return of


def test_fingerprint():
    for text in [r[1] for r in rows()] + ["A B", "a b", "Ä b c d"]:
        assert simhash.fingerprint((text or "").encode()) % (1 << 64) == plain(text)
    words = " ".join(random.Random(1).choices("abcdefgh", k=3_000_000))
    assert simhash.fingerprint(words.encode()) % (1 << 64) == plain(words)  # read in several parts


def test_masks_leave_nothing_out():
    masks = [m % (1 << 64) for m in simhash.masks(3)]
    assert len(masks) == 10
    rand = random.Random(0)
    for _ in range(2000):
        flipped = sum(1 << b for b in rand.sample(range(64), 3))
        assert any(not m & flipped for m in masks)


def near(rand, centre, bits):
    return centre ^ sum(1 << b for b in rand.sample(range(64), bits))


def test_groups_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)  # so that buckets are split
    rand = random.Random(7)
    prints = [rand.getrandbits(64) for _ in range(60)]
    prints += [near(rand, prints[0], rand.randint(0, 3)) for _ in range(60)]
    prints += [near(rand, p, rand.randint(1, 5)) for p in prints[:60]]
    chain = [rand.getrandbits(64)]
    for _ in range(40):
        chain.append(near(rand, chain[-1], 3))
    prints = sorted(set(prints + chain))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = simhash.groups(spark.createDataFrame([(s,) for s in signed] * 2, "simhash long")).collect()
    root = {r.simhash: r.root for r in found}
    of = classes(prints)
    least = {c: min(s for s, d in zip(signed, of, strict=True) if d == c) for c in of}
    assert {s: root.get(s, s) for s in signed} == {s: least[c] for s, c in zip(signed, of, strict=True)}
    assert len(found) == len(root)


def test_components(spark):
    rand = random.Random(3)
    edges = [(rand.randrange(300), rand.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7), "test").collect()}
    of = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            of[a] = of[b] = min(of[a], of[b])
    assert {n: found.get(n, n) for n in of} == of
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_near_duplicates(docs, empty):  # noqa: F811
    given = rows()
    prints = [plain(r[1]) for r in given]
    of = classes(prints)
    least = {}
    for r, c in zip(given, of, strict=True):
        least[c] = min([x for x in (least.get(c), r[0]) if x is not None], default=None)
    expected = sorted(((r[0], p, least[c]) for r, p, c in zip(given, prints, of, strict=True)), key=lambda r: [key(x) for x in r])
    found = [(r.doc_id, r.simhash % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(found, key=lambda r: [key(x) for x in r]) == expected
    assert simhash.near_duplicates(empty).count() == 0


def test_deduplicate(docs, empty):  # noqa: F811
    given = rows()
    of = classes([plain(r[1]) for r in given])
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and simhash.deduplicate(empty).count() == 0
    found = kept.collect()
    assert len(found) == len(set(of))
    by_class = {}
    for r, c in zip(given, of, strict=True):
        by_class.setdefault(c, []).append(r)
    for group in by_class.values():
        chosen = [r for r in found if tuple(r) in group]
        assert len(chosen) == 1
        assert key(chosen[0].doc_id)[1] == min((r[0] for r in group if r[0] is not None), default=0)
