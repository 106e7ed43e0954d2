"""Benchmark decontamination by greedy string tiling.

Seeds of three tokens that a document shares with benchmark items name the pairs worth comparing.
Each pair is tiled: the longest common runs are marked first, whatever their order in the
document, so a passage with its sentences in another order is still covered. A document is
contaminated by an item whose tokens are covered to ``MIN_COVERAGE`` or more.

A benchmark of up to ``BROADCAST_BYTES`` of text goes to the tasks in blocks of ``BLOCK_WORDS``
words, one broadcast each, and documents are not shuffled. A larger one is joined with the
documents on seeds, and each pair of a document and an item is tiled by itself; the result is the
same. There, what is broadcast is a bitmap of ``FILTER_BITS`` bits that spares most seeds of
documents the shuffle, and keys are spread over ``SALTS`` salts. Tiles that cover an item to
``MIN_COVERAGE`` hold a seed at a fifth of its places or more, so each item leaves out its most
frequent seeds up to a place less than that, and common wordings don't make pairs.

Tokens are runs of characters between white space and ASCII punctuation, ``A-Z`` lower-cased.
Null and empty documents are clean. Null and empty items, and those of fewer than three tokens,
which any text could hold by chance, contaminate nothing. Repeated rows are judged one by one.
"""

from __future__ import annotations

import string
from collections import defaultdict
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.text import whole_rows
from tillbook.llm.tiling import tile
from tillbook.staging import stage

SEED_TOKENS = 3
MIN_COVERAGE = 0.6
BLOCK_WORDS = 500_000
BROADCAST_BYTES = 8 << 20
FILTER_BITS = 1 << 27
SALTS = 16

_TO_TOKENS = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(),
    (string.ascii_lowercase + " " * len(string.punctuation)).encode(),
)
_RESULT = "struct<item_ids: array<bigint>, item_id: bigint, coverage: double, n_tiles: int>"


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_TOKENS).split()


class Block:
    """Some benchmark items and their seeds."""

    def __init__(self, items: list[tuple[int | None, bytes | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items = []
        seeds = defaultdict(list)
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in tokens(text)]
            if len(ids) < SEED_TOKENS:
                continue
            codes = self._codes(np.array(ids, np.int64))
            for code in set(codes.tolist()):
                seeds[code].append(len(self.items))
            self.items.append((item_id, ids))
        self.seeds = dict(seeds)
        self.codes = np.array(sorted(seeds), np.uint64)

    @staticmethod
    def _codes(ids: np.ndarray) -> np.ndarray:
        """A number for each run of SEED_TOKENS ids; runs that share one by chance don't tile."""
        count = len(ids) - SEED_TOKENS + 1
        codes = np.zeros(count, np.uint64)
        for i in range(SEED_TOKENS):
            codes = codes * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + count].astype(np.uint64)
        return codes

    def seed_places(self, ids: np.ndarray) -> np.ndarray:
        """Starts of runs in a document that are seeds."""
        if len(ids) < SEED_TOKENS or not len(self.codes):
            return np.empty(0, np.int64)
        known = ids >= 0
        count = len(ids) - SEED_TOKENS + 1
        whole = np.logical_and.reduce([known[i : i + count] for i in range(SEED_TOKENS)])
        places = np.flatnonzero(whole)
        codes = self._codes(ids)[places]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return places[self.codes[at] == codes]

    def judge(self, text: bytes | None) -> tuple[list, int | None, float, int] | None:
        """Ids of the items found, the best one, its coverage and its tiles; None if clean."""
        found = tokens(text)
        ids = np.fromiter(map(self.vocabulary.get, found, repeat(-1)), np.int64, len(found))
        places = self.seed_places(ids)
        near = defaultdict(list)
        for place, code in zip(places.tolist(), self._codes(ids)[places].tolist() if len(places) else (), strict=True):
            for item in self.seeds[code]:
                near[item].append(place)
        results = []
        for item, seeded in near.items():
            item_id, wanted = self.items[item]
            parts = self._near(ids, seeded)
            if len(parts) < MIN_COVERAGE * len(wanted):
                continue  # tiles lie within the seeds
            tiles = tile(wanted, parts, SEED_TOKENS)
            coverage = sum(n for n, _, _ in tiles) / len(wanted)
            if coverage >= MIN_COVERAGE:
                results.append((-coverage, item_id is None, item_id or 0, len(tiles), item_id))
        if not results:
            return None
        results.sort()
        ids_found = sorted({r[4] for r in results if r[4] is not None})
        return ids_found, results[0][4], -results[0][0], results[0][3]

    @staticmethod
    def _near(ids: np.ndarray, places: list[int]) -> list[int]:
        """The tokens under the seeds of one item, with a break wherever others were left out."""
        near: list[int] = []
        end = -1
        for place in sorted(set(places)):
            if place > end >= 0:
                near.append(-1)
            near.extend(ids[max(place, end) : place + SEED_TOKENS].tolist())
            end = place + SEED_TOKENS
        return near


def _judged(text: Column, block) -> Column:
    @F.pandas_udf(_RESULT)
    def judged(texts: pd.Series) -> pd.DataFrame:
        empty = (None, None, None, None)
        rows = [block.value.judge(t) or empty for t in texts]
        return pd.DataFrame(rows, columns=["item_ids", "item_id", "coverage", "n_tiles"], dtype=object)

    return judged(text.cast("binary"))


def _items(benchmark: DataFrame) -> DataFrame:
    """The distinct items; copies contaminate what one of them does."""
    return benchmark.select("item_id", F.col("text").cast("binary").alias("text")).distinct()


def _bytes(items: DataFrame) -> int:
    return items.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _blocks(items: DataFrame) -> list:
    """The benchmark in broadcasts of about BLOCK_WORDS words."""
    spark = items.sparkSession
    n_blocks = -(-_bytes(items) // (6 * BLOCK_WORDS)) or 1
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    blocks = []
    for n in range(n_blocks):
        rows = items.filter(number == n).collect()
        held = [(r.item_id, bytes(r.text) if r.text is not None else None) for r in rows]
        blocks.append(spark.sparkContext.broadcast(Block(held)))
    return blocks


def judge(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``row`` and what was found in it: ``item_ids``, best ``item_id``, ``coverage``, ``n_tiles``."""
    items = _items(benchmark)
    if _bytes(items) > BROADCAST_BYTES:
        return _judge_joined(docs, items, text)
    return _judge_broadcast(docs, items, text)


def _seeds(text: Column, bits=None) -> Column:
    """Hashes of the seeds of a text, place by place; with a bitmap, distinct ones it may hold."""

    @F.pandas_udf("array<bigint>")
    def seeds(texts: pd.Series) -> pd.Series:
        found = []
        for t in texts:
            parts = tokens(t)
            runs = map(b" ".join, zip(*(parts[i:] for i in range(SEED_TOKENS)), strict=False))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs), np.uint64)
            if bits is not None:
                place = hashes & np.uint64(FILTER_BITS - 1)
                held = bits.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)
                hashes = np.unique(hashes[held == 1])
            found.append(hashes.view(np.int64))
        return pd.Series(found)

    return seeds(text.cast("binary"))


def _bitmap(seeds: DataFrame):
    """Which hashes there are, modulo FILTER_BITS, as a broadcast of a bit each."""
    place = F.col("seed").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = seeds.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(seed & 63 AS int))")).alias("bits")
    )
    held = words.toPandas()  # FILTER_BITS / 64 rows at most
    bitmap = np.zeros(FILTER_BITS // 64, np.uint64)
    bitmap[held["word"].to_numpy(np.int64)] = held["bits"].to_numpy(np.int64).view(np.uint64)
    return seeds.sparkSession.sparkContext.broadcast(bitmap)


def _rare_seeds(items: DataFrame) -> DataFrame:
    """``item, seed, k`` without the seeds an item can spare, and the places ``need``ed of the rest.

    ``k`` is the number of places of the item at which the seed is.
    """
    placed = items.select("item", _seeds(F.col("text")).alias("seeds")).select(
        "item",
        F.ceil((MIN_COVERAGE * (F.size("seeds") + SEED_TOKENS - 1) - 1e-6) / SEED_TOKENS).alias("least"),
        F.explode("seeds").alias("seed"),
    )
    counted = placed.groupBy("item", "least", "seed").agg(F.count("*").alias("k"))
    common = counted.groupBy("seed").agg(F.count("*").alias("n_items"))
    frequent_first = Window.partitionBy("item").orderBy(F.col("n_items").desc(), "seed")
    spared = F.when(F.col("so_far") < F.col("least"), F.col("so_far"))
    return (
        counted.join(common, "seed")
        .withColumn("so_far", F.sum("k").over(frequent_first.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("need", F.col("least") - F.coalesce(F.max(spared).over(Window.partitionBy("item")), F.lit(0)))
        .filter("so_far >= least")
        .select("item", "seed", "k", "need")
    )


def _salted(df: DataFrame) -> DataFrame:
    """Each row once for every salt."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _tiled(text: Column, item: Column) -> Column:
    @F.pandas_udf("struct<coverage: double, n_tiles: int>")
    def tiled(texts: pd.Series, items: pd.Series) -> pd.DataFrame:
        found = (Block([(0, i)]).judge(t) for t, i in zip(texts, items, strict=True))
        rows = [r[2:] if r else (None, None) for r in found]
        return pd.DataFrame(rows, columns=["coverage", "n_tiles"], dtype=object)

    return tiled(text, item)


def _judge_joined(docs: DataFrame, items: DataFrame, text: str) -> DataFrame:
    """``judge`` by joins on seeds, for a benchmark of any size."""
    items = stage(items.select(F.monotonically_increasing_id().alias("item"), "*"), "items")
    seeds = stage(_rare_seeds(items), "seeds")
    rows = stage(whole_rows(docs, doc=F.monotonically_increasing_id()), "documents")
    texts = rows.select("doc", F.col("row")[text].cast("binary").alias("doc_text"))
    salt = F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int").alias("salt")
    doc_seeds = texts.select("doc", salt, F.explode(_seeds(F.col("doc_text"), _bitmap(seeds))).alias("seed"))
    near = (
        doc_seeds.join(_salted(seeds), ["seed", "salt"])
        .groupBy("doc", "item", "need")
        .agg(F.sum("k").alias("k"))
        .filter("k >= need")
    )
    pairs = (
        near.select("doc", "item", salt)
        .join(_salted(items), ["item", "salt"])
        .join(texts, "doc")
        .select("doc", "item_id", _tiled(F.col("doc_text"), F.col("text")).alias("tiles"))
        .filter("tiles.coverage IS NOT NULL")
    )
    rank = F.struct(
        (-F.col("tiles.coverage")).alias("minus"),
        F.col("item_id").isNull().alias("nameless"),
        "item_id",
        F.col("tiles.n_tiles").alias("n_tiles"),
    )
    found = pairs.groupBy("doc").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.min(rank).alias("best")
    )
    return rows.join(found, "doc", "left").select(
        "row",
        F.col("best").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.col("best.item_id").alias("item_id"),
        (-F.col("best.minus")).alias("coverage"),
        F.col("best.n_tiles").alias("n_tiles"),
    )


def _judge_broadcast(docs: DataFrame, items: DataFrame, text: str) -> DataFrame:
    """``judge`` with the whole benchmark in every task."""
    blocks = _blocks(items)
    column = F.col(f"`{text}`")
    judged = whole_rows(docs, **{f"b{n}": _judged(column, b) for n, b in enumerate(blocks)})
    found = F.filter(
        F.array(*(F.col(f"b{n}") for n in range(len(blocks)))),
        lambda r: r["coverage"].isNotNull(),
    )
    # Most covered first, then the smallest id.
    ranked = F.sort_array(
        F.transform(
            found,
            lambda r: F.struct(
                (-r["coverage"]).alias("minus"),
                r["item_id"].isNull().alias("nameless"),
                r["item_id"].alias("item_id"),
                r["n_tiles"].alias("n_tiles"),
            ),
        )
    )
    ids = F.sort_array(F.array_distinct(F.flatten(F.transform(found, lambda r: r["item_ids"]))))
    best = F.get(F.col("ranked"), F.lit(0))
    return judged.select("row", ids.alias("item_ids"), ranked.alias("ranked")).select(
        "row",
        (F.size("ranked") > 0).alias("contaminated"),
        "item_ids",
        best["item_id"].alias("item_id"),
        (-best["minus"]).alias("coverage"),
        best["n_tiles"].alias("n_tiles"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents without a benchmark item, with their own columns."""
    return judge(docs, benchmark).filter("NOT contaminated").select("row.*")


def op7(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: ``contaminated``, and by what."""
    return judge(docs, benchmark).select(
        F.col("row.doc_id").alias("doc_id"),
        "contaminated",
        "item_id",
        "coverage",
        "n_tiles",
        F.array_join(F.col("item_ids").cast("array<string>"), ",").alias("item_ids"),
    )
