"""Data-profiling queries over raw orders and rates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, from one pass; NaN counts as missing."""
    types = dict(df.dtypes)

    def missing(name: str):
        column = F.col(f"`{name}`")
        gone = column.isNull()
        if types[name] in ("double", "float"):
            gone = gone | F.isnan(column)
        return F.count_if(gone).alias(name)

    counts = df.agg(*(missing(name) for name in df.columns))
    return counts.unpivot(
        [], [F.col(f"`{name}`") for name in df.columns], "column_name", "null_count"
    )


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*(F.col(f"`{c}`").asc_nulls_last() for c in order_by)).limit(rows)


def _largest_groups(df: DataFrame, column: str, alias: str, count: str, rows: int) -> DataFrame:
    return (
        df.groupBy(F.col(column).alias(alias))
        .agg(F.count(F.lit(1)).alias(count))
        .orderBy(F.col(count).desc(), F.col(alias).asc_nulls_last())
        .limit(rows)
    )


def top_countries(raw: DataFrame, rows: int = 5) -> DataFrame:
    """Countries with the most lines."""
    return _largest_groups(raw, "Country", "country", "count", rows)


def top_invoices(raw: DataFrame, rows: int = 5) -> DataFrame:
    """Invoices with the most lines."""
    return _largest_groups(raw, "Invoice", "invoice", "total", rows)


def with_customer_copy(raw: DataFrame) -> DataFrame:
    """The customer column once more, under a name without a space."""
    return raw.withColumn("CustomerID", F.col("Customer ID"))


def dated_rates(rates: DataFrame, view: str = "dated_rates") -> DataFrame:
    """Register rates by year, month name and day as a temporary view, and read it."""
    rates.select(
        F.year("date").alias("year"),
        F.date_format("date", "MMMM").alias("month"),
        F.day("date").alias("day"),
        "gbp_to_usd",
    ).createOrReplaceTempView(view)
    return rates.sparkSession.table(view)


def over_length(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows with text longer than a warehouse column takes."""
    too_long = [F.length(name) > limit for name, limit in limits.items()]
    return df.filter(reduce(lambda a, b: a | b, too_long))
