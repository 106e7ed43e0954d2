"""Messages that cannot be read, with the reason, by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.operators.events import MESSAGE, REASON
from tillbook.schemas import QUARANTINED
from tillbook.sinks.lake import write_partitions


def put_aside(batch: DataFrame, batch_id: int, quarantine: str) -> None:
    """Write a batch's unreadable messages to its own folder; a retry replaces them."""
    bad = batch.filter(F.col(REASON).isNotNull()).select(
        F.col(MESSAGE).alias("value"),
        F.col(REASON).alias("reason"),
        F.lit(batch_id).cast("long").alias("batch_id"),
    )
    write_partitions(bad, quarantine, "batch_id")


def readable(batch: DataFrame) -> DataFrame:
    """The events of a batch."""
    return batch.filter(F.col(REASON).isNull()).drop(MESSAGE, REASON)


def read_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """All messages put aside."""
    return spark.read.schema(QUARANTINED).parquet(quarantine)
