"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``d`` bits share a variant within ``ceil(d / 2)`` bits of both. So every
distinct fingerprint emits all its variants of that half radius, the variants are shuffled, and
what meets in one variant is deduplicated and verified. Exact copies are one fingerprint before
that, and a variant can only be met by the fingerprints around it (65 for ``d`` = 2), so no group
of copies, however large, makes a large group of pairs.

Null and empty texts have the fingerprint zero and are linked like others. A null id is kept; it
never becomes a ``component_id`` unless all ids of the component are null. Repeated rows stay
repeated in ``op1`` and count as copies in ``keep_one``.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.components import components
from tillbook.llm.text import whole_rows
from tillbook.staging import stage

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BITS = 64
# Shingles hashed at once, which bounds memory in a very long text.
_BLOCK = 1 << 16


def fingerprint(text: bytes | None, k: int = SHINGLE_WORDS) -> int:
    """The SimHash of a UTF-8 text, as a signed 64-bit number."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    k = min(k, len(tokens))
    n = len(tokens) - k + 1
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, _BLOCK):
        part = tokens[start : start + _BLOCK + k - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(k)), strict=False))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
        bits = np.unpackbits(
            hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def simhash(text: Column, k: int = SHINGLE_WORDS) -> Column:
    """``fingerprint`` as a column; texts travel to Python in Arrow batches, numbers back."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, k) for t in texts], dtype="int64")

    return hashed(text.cast("binary"))


def _flips(radius: int) -> list[int]:
    """Signed masks of at most ``radius`` bits."""
    places = [1 << i for i in range(BITS - 1)] + [-(1 << (BITS - 1))]
    masks = [0]
    for n in range(1, radius + 1):
        for chosen in combinations(places, n):
            mask = 0
            for bit in chosen:
                mask ^= bit
            masks.append(mask)
    return masks


def near_links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a, b`` between distinct values of ``fp``, enough to connect all near ones.

    In a variant, each fingerprint is linked to the smallest one there; two of them within
    ``max_bits`` of each other, but not of the smallest, would otherwise be lost, so for an odd
    ``max_bits``, where that can be, all pairs of the bounded ball are verified.
    """
    half = -(-max_bits // 2)
    met = fingerprints.select(
        "fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(F.lit(m)) for m in _flips(half)))).alias("v")
    )
    if max_bits % 2 == 0:
        lowest = met.select("fp", F.min("fp").over(Window.partitionBy("v")).alias("a"))
        pairs = lowest.filter("fp <> a").select("a", F.col("fp").alias("b"))
    else:
        other = met.select(F.col("fp").alias("b"), "v")
        pairs = met.join(other, "v").filter("fp < b").select(F.col("fp").alias("a"), "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return pairs.distinct().filter(near)


def classes(hashed: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Per distinct ``fp``: ``first`` id with it, ``root`` and smallest id of its component.

    ``hashed`` has ``doc_id, fp``, and should be stored.
    """
    firsts = stage(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(near_links(firsts, max_bits))
    rooted = firsts.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    return rooted.join(lowest, "root").select("fp", "first", "root", "component")


def op1(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` in 16 hex digits, and ``component_id``."""
    hashed = stage(docs.select("doc_id", simhash(F.col("text")).alias("fp")), "simhash")
    return hashed.join(classes(hashed), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_one(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, that with the smallest id (null ids last), input columns only.

    Of rows with that id in one component, the smallest fingerprint stays, and of its rows one.
    Rows are stored once beside their fingerprint and a number; only numbers are grouped, and the
    rows come back by one join that hashes the kept numbers, so texts are neither sorted nor
    grouped.
    """
    rows = stage(
        whole_rows(
            docs,
            doc_id=F.col("doc_id"),
            fp=simhash(F.col("text"), k),
            number=F.monotonically_increasing_id(),
        ),
        "simhash",
    )
    narrow = rows.select("doc_id", "fp", "number")
    best = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "fp", "number")
    kept = (
        narrow.groupBy("fp")
        .agg(F.min(best).alias("best"))
        .join(classes(narrow, max_bits).select("fp", "root"), "fp")
        .groupBy("root")
        .agg(F.min("best").alias("best"))
        .select(F.col("best.number").alias("kept"))
    )
    found = rows.join(kept.hint("shuffle_hash"), rows["number"] == kept["kept"], "left_semi")
    return found.select("row.*")
