"""What the text operators share: tables, words and the six white-space characters between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of other characters than these.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CHAR_CLASS = r"[^\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for a null text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    split = F.split(inner, f"{SPACE_CLASS}+")
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(split)


def whole_rows(docs: DataFrame, **columns: Column) -> DataFrame:
    """Each row as the struct ``row``, beside columns computed from it.

    Wrapped like this, columns of the input that share a name with a computed one do no harm;
    ``.select("row.*")`` gives the input's columns back.
    """
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        *(column.alias(name) for name, column in columns.items()),
    )
