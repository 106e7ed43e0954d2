from __future__ import annotations

import math
import random

import public_tokenizers
from cases import documents, frame, split
from tokenizers import Tokenizer, models

from tillbook.llm import tokens

SCORES = {"▁": -2.0, "a": -1.5, "b": -1.5, "ab": -2.5, "▁a": -3.0, "ba": -3.0, "aba": -4.5, "é": -2.0}


def plain(word, scores):
    """Tokens of the best split, by trying every split."""
    text = tokens.MARK + word
    low = min(scores.values()) - tokens.BYTE_PENALTY
    longest = max(map(len, scores))
    best = {0: (0.0, 0)}
    for end in range(1, len(text) + 1):
        ways = [
            (best[s][0] + scores[text[s:end]], -best[s][1] - 1)
            for s in range(max(0, end - longest), end) if text[s:end] in scores
        ]
        if text[end - 1] not in scores:
            n = len(text[end - 1].encode())
            ways.append((best[end - 1][0] + n * low, -best[end - 1][1] - n))
        score, minus = max(ways)
        best[end] = score, -minus
    return best[len(text)][1]


def test_against_every_split():
    r = random.Random(1)
    trie = tokens.PrefixScores(SCORES)
    for _ in range(2000):
        word = "".join(r.choice("abé日") for _ in range(r.randint(1, 12)))
        assert trie.count(word.encode()) == (1, plain(word, SCORES))
    assert len(trie.best) < 20_000


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_NODES", 10)
    monkeypatch.setattr(tokens, "MAX_SHARED_CHARS", 5)
    trie = tokens.PrefixScores(SCORES)
    for word in ("ab", "aba", "abab" * 5, "bab", "ab", "日本"):
        assert trie.count(word.encode())[1] == plain(word, SCORES)


def test_shared_prefixes_are_scored_once():
    trie = tokens.PrefixScores(SCORES)
    trie.count(b"abab ababa abab abb")
    assert len(trie.best) == 1 + len({("▁" + w)[:i] for w in ("abab", "ababa", "abb") for i in range(1, 7) if i <= len(w) + 1})


def test_whole_vocabulary(spark):
    scores = tokens.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    assert math.isclose(sum(map(math.exp, scores.values())), 1)
    docs = documents()
    counted = tokens.op10(frame(spark, docs)).collect()
    words = {w for _, t in docs for w in split(t)}
    by_word = {w: plain(w, scores) for w in words}
    want = [(d, len(split(t)), sum(by_word[w] for w in split(t))) for d, t in docs]
    assert sorted(map(str, map(tuple, counted))) == sorted(map(str, want))
    # The same vocabulary in another implementation of unigram tokenization.
    other = Tokenizer(models.Unigram([("<unk>", -1e9), *scores.items()], unk_id=0))
    for w in words:
        if len(w) < 100 and all(c in scores for c in w):
            assert len(other.encode(tokens.MARK + w).ids) == by_word[w]


def test_empty_table(spark):
    assert tokens.op10(frame(spark, [])).collect() == []
