"""Token counts of a unigram vocabulary, with forward scores shared along a trie.

The score of the best split of a pre-token's prefix depends on that prefix alone. So a task keeps
a trie of the distinct pre-tokens it has met; a new one walks down what it shares with earlier
ones and computes scores only for its own letters, and the count of tokens at its end is stored.
Documents are not shuffled. The trie starts anew at ``MAX_NODES``, which bounds memory and changes
no count; longer pre-tokens than ``MAX_SHARED_CHARS`` are scored beside it.

A pre-token is a run of other characters than the six ASCII spaces, after the vocabulary's mark
for a word's start. Splits are compared by score, then by fewer tokens. A character outside the
vocabulary is as many tokens as it has bytes. Null and empty texts have none; repeated rows and
null ids are counted like others.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.text import whole_rows

MARK = "▁"
MAX_NODES = 1_000_000
MAX_SHARED_CHARS = 64
# A vocabulary is sent to the tasks, up to so many pieces.
MAX_PIECES = 2_000_000
# A byte's score lies this far below the lowest piece's.
BYTE_PENALTY = 10.0


class PrefixScores:
    """Best scores and token counts of every prefix met, as a trie."""

    def __init__(self, scores: Mapping[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.byte_score = min(scores.values(), default=0.0) - BYTE_PENALTY
        self.counts: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, int] = {}
        self.best = [0.0]
        self.tokens = [0]
        self.counts.clear()

    def _after(self, text: str, end: int, best: list[float], tokens: list[int]) -> tuple[float, int]:
        """Score and tokens of ``text[:end]`` from those of shorter prefixes."""
        scores = self.scores
        top, fewest = -math.inf, 0
        for start in range(max(0, end - self.longest), end):
            score = scores.get(text[start:end])
            if score is not None:
                score += best[start]
                if score > top or (score == top and tokens[start] + 1 < fewest):
                    top, fewest = score, tokens[start] + 1
        last = text[end - 1]
        if last not in scores:
            size = len(last.encode(errors="surrogatepass"))
            score = best[end - 1] + size * self.byte_score
            if score > top or (score == top and tokens[end - 1] + size < fewest):
                top, fewest = score, tokens[end - 1] + size
        return top, fewest

    def beside(self, text: str) -> int:
        """Tokens of a text, without the trie."""
        best, tokens = [0.0], [0]
        for end in range(1, len(text) + 1):
            score, count = self._after(text, end, best, tokens)
            best.append(score)
            tokens.append(count)
        return tokens[-1]

    def insert(self, text: str) -> int:
        """Tokens of a text, whose prefixes are kept."""
        node = 0
        best, tokens = [0.0], [0]
        for end, letter in enumerate(text, 1):
            key = (node << 21) | ord(letter)
            node = self.children.get(key, 0)
            if not node:
                node = self.children[key] = len(self.best)
                score, count = self._after(text, end, best, tokens)
                self.best.append(score)
                self.tokens.append(count)
            best.append(self.best[node])
            tokens.append(self.tokens[node])
        return tokens[-1]

    def count(self, text: bytes | None) -> tuple[int, int]:
        """Pre-tokens and tokens of a text."""
        words = (text or b"").split()
        counts = self.counts
        total = 0
        for word in words:
            n = counts.get(word)
            if n is None:
                marked = MARK + word.decode(errors="replace")
                if len(marked) > MAX_SHARED_CHARS:
                    n = self.beside(marked)
                else:
                    if len(self.best) > MAX_NODES:
                        self.clear()
                    n = counts[word] = self.insert(marked)
            total += n
        return len(words), total


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """Log-probabilities of pieces in order of rank.

    A vocabulary of merges holds ranks, not probabilities; Zipf's law turns one into the other.
    """
    total = sum(1 / (rank + 2) for rank in range(len(pieces)))
    return {piece: -math.log((rank + 2) * total) for rank, piece in enumerate(pieces)}


def read_vocabulary(path: str) -> dict[str, float]:
    """The ordinary pieces of a sentencepiece model with their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.get_piece_size() > MAX_PIECES:
        raise ValueError(f"{path} has more pieces than a vocabulary should")
    ids = range(model.get_piece_size())
    ordinary = [
        i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    ordinary.sort(key=lambda i: (-model.get_score(i), i))
    return zipf_scores([model.id_to_piece(i) for i in ordinary])


@lru_cache(maxsize=2)
def _kept(items: tuple[tuple[str, float], ...]) -> PrefixScores:
    """One trie per Python worker and vocabulary, kept from task to task."""
    return PrefixScores(dict(items))


def _counts(text: Column, vocabulary) -> Column:
    @F.pandas_udf("struct<n_pretokens: bigint, n_tokens: bigint>")
    def counts(texts: pd.Series) -> pd.DataFrame:
        trie = _kept(vocabulary.value)
        return pd.DataFrame(
            [trie.count(t) for t in texts], columns=["n_pretokens", "n_tokens"], dtype="int64"
        )

    return counts(text.cast("binary"))


def share_vocabulary(spark: SparkSession, scores: Mapping[str, float]):
    """A vocabulary as a broadcast of checked size."""
    if len(scores) > MAX_PIECES:
        raise ValueError("a vocabulary of this size is not sent to the tasks")
    return spark.sparkContext.broadcast(tuple(scores.items()))


def count_tokens(docs: DataFrame, scores: Mapping[str, float], text: str = "text") -> DataFrame:
    """``row`` with ``n_pretokens`` and ``n_tokens``."""
    vocabulary = share_vocabulary(docs.sparkSession, scores)
    counted = whole_rows(docs, counts=_counts(F.col(f"`{text}`"), vocabulary))
    return counted.select("row", "counts.n_pretokens", "counts.n_tokens")


def op10(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document with its counts."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    counted = count_tokens(docs, read_vocabulary(path))
    return counted.select(F.col("row.doc_id").alias("doc_id"), "n_pretokens", "n_tokens")
