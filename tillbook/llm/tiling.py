"""Greedy string tiling of two token sequences by running Karp-Rabin hashes."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import groupby

_MODULUS = (1 << 61) - 1
_BASE = 1_000_003


def _windows(tokens: Sequence[int], marked: Sequence[bool], size: int) -> Iterator[tuple[int, int]]:
    """``(start, hash)`` of each window of unmarked tokens, each hash from the one before it."""
    top = pow(_BASE, size - 1, _MODULUS)
    value = run = 0
    for i, token in enumerate(tokens):
        if marked[i] or token < 0:
            value = run = 0
            continue
        if run == size:
            value -= (tokens[i - size] + 1) * top
            run -= 1
        value = (value * _BASE + token + 1) % _MODULUS
        run += 1
        if run == size:
            yield i - size + 1, value


def _open(tokens: Sequence[int], marked: Sequence[bool]) -> int:
    """Length of the longest run of unmarked tokens."""
    free = (not m and t >= 0 for t, m in zip(tokens, marked, strict=True))
    return max((sum(1 for _ in run) for is_free, run in groupby(free) if is_free), default=0)


def _share(
    a: Sequence[int], b: Sequence[int], in_a: list[bool], in_b: list[bool], size: int
) -> bool:
    """Whether there is an unmarked common run of ``size`` tokens."""
    places = defaultdict(list)
    for i, value in _windows(a, in_a, size):
        places[value].append(i)
    return any(
        a[i : i + size] == b[j : j + size]
        for j, value in _windows(b, in_b, size)
        for i in places.get(value, ())
    )


def _mark(
    a: Sequence[int], b: Sequence[int], in_a: list[bool], in_b: list[bool], size: int
) -> list[tuple[int, int, int]]:
    """Mark common runs of ``size`` tokens, the longest there are, the earliest first."""
    places = defaultdict(list)
    for j, value in _windows(b, in_b, size):
        places[value].append(j)
    for starts in places.values():
        starts.reverse()
    tiles = []
    for i, value in _windows(a, in_a, size):
        # Runs marked here are as long as a window, so one that overlaps it covers an end of it.
        if in_a[i] or value not in places:
            continue
        starts = places[value]
        while starts and (in_b[starts[-1]] or in_b[starts[-1] + size - 1]):
            starts.pop()
        for j in reversed(starts):
            if in_b[j] or in_b[j + size - 1] or a[i : i + size] != b[j : j + size]:
                continue
            in_a[i : i + size] = in_b[j : j + size] = [True] * size
            tiles.append((size, i, j))
            break
    return tiles


def tile(a: Sequence[int], b: Sequence[int], shortest: int) -> list[tuple[int, int, int]]:
    """Non-overlapping common runs of ``shortest`` or more tokens, longest first.

    Returns ``(length, start in a, start in b)``; of equal lengths the earliest in ``a``, then in
    ``b``, is taken. Negative tokens match nothing. The length of the longest run is found by
    halving, as a common run holds common runs of all smaller lengths; marking takes all runs of
    that length at once. Lengths fall, and tiles fit into ``a``, so there are at most about
    ``sqrt(2 * len(a))`` lengths, and the work grows with ``len(a) + len(b)`` for each.
    """
    in_a, in_b = [False] * len(a), [False] * len(b)
    tiles: list[tuple[int, int, int]] = []
    size = min(len(a), len(b)) + 1
    while True:
        low, size = shortest - 1, min(size - 1, _open(a, in_a), _open(b, in_b))
        while low < size:
            middle = (low + size + 1) // 2
            if _share(a, b, in_a, in_b, middle):
                low = middle
            else:
                size = middle - 1
        if size < shortest:
            return tiles
        tiles += _mark(a, b, in_a, in_b, size)
