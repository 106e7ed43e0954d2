from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from cases import documents, frame, split

from tillbook.llm import periodic


def plain_runs(words, min_length=24, exponent=3):
    """Every stretch that has a period and can't be extended, by trying every period."""
    n = len(words)
    found = {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            # The smallest period of a stretch comes first.
            if end - start >= max(min_length, exponent * q) and (start, end) not in found:
                found[start, end] = q
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-(r[1] * 10**9 // r[2]), r[0], r[2]), default=None)
    if best and len(runs) > 1:
        from fractions import Fraction

        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    dropped = {i for s, n_, q in runs for i in range(s + q, s + n_)}
    kept = [w for i, w in enumerate(words) if i not in dropped]
    listed = "".join(f"{s},{n_},{q}\n" for s, n_, q in runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *top, sha(listed), sha(" ".join(kept)))


def random_words(r):
    words = []
    for _ in range(r.randint(1, 5)):
        kind = r.random()
        if kind < 0.7:
            unit = [r.choice("ab" if r.random() < 0.5 else "abcdef") for _ in range(r.randint(1, 9))]
            words += (unit * 20)[: r.randint(1, len(unit) * 12)]
        else:
            words += [r.choice("abcd") for _ in range(r.randint(1, 20))]
    return [w.encode() for w in words]


@pytest.mark.parametrize("min_length", [6, 24])
def test_against_every_period(min_length):
    r = random.Random(5)
    several = 0
    for _ in range(1500):
        words = random_words(r)
        want = plain_runs(words, min_length)
        several += len(want) > 1
        assert periodic.runs(words, min_length) == want
    assert several > 100


def test_runs_within_runs():
    unit = [b"x"] * 30 + [b"y"]
    words = unit * 4
    want = plain_runs(words)
    assert (0, 124, 31) in want and len(want) == 5
    assert periodic.runs(words) == want


def test_two_periods_are_refused():
    with pytest.raises(ValueError, match="three"):
        periodic.runs([b"a"] * 30, exponent=2)


def test_a_long_document_of_one_word():
    assert periodic.runs([b"a"] * 30_000) == [(0, 30_000, 1)]


def test_repeats_are_never_missed():
    r = random.Random(2)
    docs = [random_words(r) for _ in range(300)]
    named = periodic.repeats(docs, 16)
    for number, words in enumerate(docs):
        windows = [tuple(words[i : i + 16]) for i in range(len(words) - 15)]
        assert (number in named) == (len(set(windows)) < len(windows))
    assert periodic.repeats([], 16) == set()
    assert periodic.repeats([[b"a"], []], 16) == set()


def test_whole_query(spark, monkeypatch):
    docs = documents()
    r = random.Random(3)
    docs += [(5000 + i, " ".join(w.decode() for w in random_words(r))) for i in range(120)]
    docs += [(6000, "ha " * 5000), (6001, "tick tock " * 12), (6002, "tick tock " * 11)]
    docs = [(d, t) for d, t in docs if t is None or len(t) < 60_000]
    monkeypatch.setattr(periodic, "BLOCK_WORDS", 500)
    found = sorted(map(str, map(tuple, periodic.op12(frame(spark, docs)).collect())))
    assert found == sorted(str(plain_row(d, t)) for d, t in docs)
    assert any("6002, 0" in row for row in found)


def test_empty_table(spark):
    result = periodic.op12(frame(spark, []))
    assert result.collect() == []
    assert result.columns[0] == "doc_id"
