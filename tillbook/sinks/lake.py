"""Parquet tables in the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace only the partitions that ``df`` has rows for; writing twice changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )
