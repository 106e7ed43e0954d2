"""The operators of this subpackage as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillbook.llm import (
    chat,
    decontaminate,
    licenses,
    packing,
    periodic,
    pii,
    quality,
    simhash,
    spelling,
    substrings,
    tokens,
    toxicity,
    urls,
)
from tillbook.llm.text import read


def _over(table: str, operator: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: operator(read(spark, sf_dir, table))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": _over("documents", simhash.op1),
    "op2_substrings": _over("documents", substrings.op2),
    "op3_licenses": _over("documents", licenses.op3),
    "op4_chat": _over("conversations", chat.op4),
    "op5_quality": _over("documents", quality.op5),
    "op6_packing": _over("documents", packing.op6),
    "op7_decontamination": lambda spark, sf_dir: decontaminate.op7(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    ),
    "op8_pii": _over("documents", pii.op8),
    "op9_urls": lambda spark, sf_dir: urls.op9(
        read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels")
    ),
    "op10_tokens": _over("documents", tokens.op10),
    "op11_spelling": _over("documents", spelling.op11),
    "op12_periodic": _over("documents", periodic.op12),
    "op13_toxicity": lambda spark, sf_dir: toxicity.op13(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    ),
}

# The others cannot be said in SQL; their tests compare them with brute force.
ORACLES: dict[str, str] = {
    "op2_substrings": substrings.OP2_SQL,
    "op3_licenses": licenses.OP3_SQL,
    "op5_quality": quality.OP5_SQL,
    "op9_urls": urls.OP9_SQL,
}
