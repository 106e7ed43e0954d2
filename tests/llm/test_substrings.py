from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from cases import documents, frame, split

from tillbook.llm import substrings


def plain(docs, window=20):
    """``doc_id, n_words, n_removed, kept`` by comparing every window with all earlier ones."""
    first = {}
    words = [split(t) for _, t in docs]
    for (doc_id, _), w in zip(docs, words, strict=True):
        for i in range(len(w) - window + 1):
            key, at = tuple(w[i : i + window]), (doc_id is None, doc_id or 0, i)
            first[key] = min(first.get(key, at), at)
    rows = []
    for (doc_id, _), w in zip(docs, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (doc_id is None, doc_id or 0, i):
                gone.update(range(i, i + window))
        rows.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return rows


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def passages(seed):
    r = random.Random(seed)
    shared = [[f"p{k}x{r.randrange(50)}" for _ in range(r.randint(15, 70))] for k in range(8)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(r.randint(0, 5)):
            words += [f"u{r.randrange(10**6)}" for _ in range(r.randint(0, 25))]
            p = r.choice(shared)
            a = r.randint(0, 10)
            words += p[a : a + r.randint(10, 70)]
        docs.append((r.randrange(10**6), " ".join(words)))
    docs += [(10**7, "one two " * 300), (10**7 + 1, "x")]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(spark, seed):
    docs = passages(seed) + documents(seed)
    rows = substrings.remove_repeats(
        frame(spark, docs), chunk_bytes=2000, bucket_words=1500
    ).collect()
    got = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows], key=key)
    assert got == sorted(plain(docs), key=key)
    for r in rows:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_digest(spark):
    docs = passages(3)
    want = sorted(
        (d, n, m, hashlib.sha256(kept.encode()).hexdigest()) for d, n, m, kept in plain(docs)
    )
    assert sorted(map(tuple, substrings.op2(frame(spark, docs)).collect())) == want


@pytest.mark.parametrize("window", [5, 6])
def test_other_windows(spark, window):
    docs = passages(5)
    rows = substrings.remove_repeats(frame(spark, docs), window).collect()
    got = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows], key=key)
    assert got == sorted(plain(docs, window), key=key)


def test_empty_table(spark):
    assert substrings.op2(frame(spark, [])).collect() == []


def test_packing():
    values = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, np.uint64))
    assert (substrings.unpack_sorted(substrings.pack_sorted(values), np.uint64) == values).all()
    assert len(substrings.unpack(substrings.pack(values[:0]), np.uint64)) == 0
