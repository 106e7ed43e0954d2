"""Periodic runs of words by maximal pairs of a suffix array.

A run is a stretch of words with a smallest period that neither neighbour continues, at least
``MIN_LENGTH`` words and ``MIN_EXPONENT`` periods long. Its words and the same words one period
later are a maximal pair: equal over (length - period) words and over no more on either side.

The longest-common-prefix intervals of a document's suffix array form a tree, which is walked
from the leaves up. An interval holds its places in order, each in the class of the word on its
left. Where a child joins its parent, places of both in different left-word classes are a pair
that is maximal, with the interval's prefix as its length. Of these only pairs closer than
prefix / (exponent - 1) are runs. Occurrences of a prefix that are so close are steps of its
smallest period, so the two places of a run are next to each other among the places of both: the
smaller list's places are looked up in the larger one's, and nothing is extended afterwards.

A document is one task's work, and its memory grows with its words times the logarithm of its
longest repeat. Null and empty texts have no run, and an empty result. Repeated rows are worked
on again, and documents without an id are taken as they are.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 24
# Below three, a pair need not be next to each other in its interval.
MIN_EXPONENT = 3
# Documents are searched together for repeats, about so many words at a time.
BLOCK_WORDS = 1 << 17

Run = tuple[int, int, int]

_SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
)


def least_prefix(min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> int:
    """The shortest maximal pair of a run: its length less one period."""
    return min_length - min_length // exponent


def suffix_order(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of a document, and the prefix that each suffix shares with the one before.

    Ranks of prefixes double in length until all differ; the kept ranks of every length then
    give shared prefixes from the longest step down.
    """
    n = len(words)
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    levels = [rank]
    while (step := 1 << (len(levels) - 1)) < n and int(rank.max()) < n - 1:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        rank = np.unique(key, return_inverse=True)[1]
        levels.append(rank)
    order = np.argsort(rank, kind="stable")
    shared = np.zeros(n, np.int64)
    if n > 1:
        at, other = order[1:].copy(), order[:-1].copy()
        for level in range(len(levels) - 1, -1, -1):
            inside = np.maximum(at, other) < n
            same = np.zeros(n - 1, bool)
            rank = levels[level]
            same[inside] = rank[at[inside]] == rank[other[inside]]
            step = same.astype(np.int64) << level
            at, other = at + step, other + step
            shared[1:] += step
    return order, shared


class _Interval:
    """An interval of suffixes that share ``prefix`` words, with their places in order."""

    __slots__ = ("places", "prefix")

    def __init__(self, prefix: int, places: list[int]):
        self.prefix = prefix
        self.places = places

    def join(self, child: list[int], left: list[int], exponent: int) -> Iterator[tuple[int, int]]:
        """Take in a child's places; yields near maximal pairs as ``(start, distance)``."""
        large, small = self.places, child
        if len(large) < len(small):
            large, small = small, large
        reach = self.prefix // (exponent - 1)
        for t, place in enumerate(small):
            k = bisect_left(large, place)
            if k:
                before = large[k - 1]
                near = place - before <= reach and not (t and small[t - 1] > before)
                if near and left[place] != left[before]:
                    yield before, place - before
            if k < len(large):
                after = large[k]
                near = after - place <= reach and not (t + 1 < len(small) and small[t + 1] < after)
                if near and left[place] != left[after]:
                    yield place, after - place
        if len(small) < 16:
            for place in small:
                insort(large, place)
        else:
            large += small
            large.sort()
        self.places = large


def runs(
    words: list[bytes], min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT
) -> list[Run]:
    """``(start, length, period)`` of every run of a document, by start and period."""
    if exponent < 3:
        raise ValueError("runs of fewer than three periods are not found by this method")
    n = len(words)
    least = least_prefix(min_length, exponent)
    if n < min_length:
        return []
    order, shared = suffix_order(words)
    ids: dict[bytes, int] = {}
    left = [-1, *(ids.setdefault(w, len(ids)) for w in words[:-1])]
    found: list[Run] = []
    stack: list[_Interval] = []

    def join(parent: _Interval, child: list[int]) -> None:
        for start, distance in parent.join(child, left, exponent):
            if parent.prefix + distance >= min_length:
                found.append((start, parent.prefix + distance, distance))

    prefixes = [*shared[1:].tolist(), 0]
    for place, prefix in zip(order.tolist(), prefixes, strict=True):
        # Shorter prefixes make no run; their intervals need not be kept.
        if prefix < least and not stack:
            continue
        child = [place]
        while stack and stack[-1].prefix > prefix:
            parent = stack.pop()
            join(parent, child)
            child = parent.places
        if prefix >= least:
            if stack and stack[-1].prefix == prefix:
                join(stack[-1], child)
            else:
                stack.append(_Interval(prefix, child))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], found: Iterable[Run]) -> list[bytes]:
    """The words that no run contains after its first period."""
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = np.cumsum(dropped[:-1]) == 0
    return [w for w, keep in zip(words, kept.tolist(), strict=True) if keep]


def repeats(documents: list[list[bytes]], size: int) -> set[int]:
    """Numbers of the documents in which some ``size`` consecutive words come twice.

    A run needs that, and most documents have none. Words and windows are hashed, so a document
    may be named without need, and none is left out.
    """
    counts = np.array([len(words) for words in documents])
    h = np.fromiter(map(hash, chain.from_iterable(documents)), np.int64).astype(np.uint64)
    n = len(h)
    if n < size:
        return set()
    # The hash of a window from those of two halves of it that may overlap.
    width, mult = 1, np.uint64(0x9E3779B97F4A7C15)
    while width < size:
        step = min(width, size - width)
        h = h[:-step] * mult + (h[step:] ^ (h[step:] >> np.uint64(29)))
        width += step
    number = np.repeat(np.arange(len(documents)), counts)[: len(h)]
    ends = np.cumsum(counts)
    whole = np.arange(len(h)) + size <= ends[number]
    h, number = h[whole], number[whole]
    mixed = h ^ (number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(mixed, kind="stable")
    mixed = mixed[order]
    return set(number[order[1:]][mixed[1:] == mixed[:-1]].tolist())


def echoed(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's planted repetition: in one document of ten, the words from a place on repeat."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * (-(-(n - a) // len(period))))[: n - a]


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _row(doc_id: int | None, words: list[bytes], found: list[Run]) -> dict:
    row = {"doc_id": doc_id, "n_runs": len(found)}
    if found:
        start, length, period = found[0]
        for run in found[1:]:
            # Runs come by start and period, so of equal ones the first stays.
            if run[1] * period > length * run[2]:
                start, length, period = run
        row |= {"start": start, "length": length, "period": period}
        row["exponent_milli"] = 1000 * length // period
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in found)
    row["runs_sha256"] = _sha256(listed.encode())
    row["collapsed_sha256"] = _sha256(b" ".join(collapse(words, found) if found else words))
    return row


def _blocks(batch: pa.RecordBatch) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    block, size = [], 0
    for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
        words = echoed(doc_id.as_py(), (text.as_py() or b"").split())
        block.append((doc_id.as_py(), words))
        size += len(words)
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _rows(block: list[tuple[int | None, list[bytes]]]) -> list[dict]:
    worth = repeats([words for _, words in block], least_prefix())
    return [
        _row(doc_id, words, runs(words) if number in worth else [])
        for number, (doc_id, words) in enumerate(block)
    ]


def op12(docs: DataFrame) -> DataFrame:
    """Runs and the text without their repetitions, as digests, of every document."""
    fields = pa.schema(
        [
            (name, pa.string() if kind == "string" else pa.int64())
            for name, kind in (field.split(" ") for field in _SCHEMA.split(", "))
        ]
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch):
                yield pa.RecordBatch.from_pylist(_rows(block), fields)

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    return texts.mapInArrow(found, _SCHEMA)
