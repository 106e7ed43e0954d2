"""Documents that every text operator must bear."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = "the of and Reiß über été niño A x, y. foo foo bar 日本 😀".split()
LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def documents(seed: int = 1, n: int = 60) -> list[tuple[int | None, str | None]]:
    """Random texts with null, empty and long ones, repeated rows and null ids."""
    r = random.Random(seed)
    docs: list[tuple[int | None, str | None]] = []
    for i in range(n):
        text = "".join(
            r.choice(WORDS) + r.choice([" ", " ", "  ", "\n", "\t", "\n\n", " "])
            for _ in range(r.randint(0, 90))
        )
        docs.append((i, text))
        if r.random() < 0.3:
            docs.append((1000 + i, text))
        if r.random() < 0.2:
            docs.append((2000 + i, text + " end"))
    docs += [(3000, None), (3001, ""), (3002, " \n\t "), (3003, "word"), (3004, "word")]
    docs += [(None, "the only one without an id"), (None, None), (None, "")]
    docs += [(5, docs[5][1]), docs[7], docs[7]]
    docs += [(3005, LONG), (3006, "x" * 50_000)]
    return docs


def frame(spark: SparkSession, docs, parts: int = 3) -> DataFrame:
    """With extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts)
    clashes = ("row", "words", "fp", "root", "first", "n_words", "kept", "spans", "base", "b0", "place")
    return df.select("*", *(F.lit(c).alias(c) for c in clashes))


def split(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]
