"""Exchange rates from landed rate responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.schemas import RATE_RESPONSE, STREAM_FALLBACK_RATE


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed response files, one JSON document each, in ``value``."""
    return spark.read.text(path, wholetext=True)


def flatten_rates(responses: DataFrame) -> DataFrame:
    """``{"rates": {day: {"USD": x}}}`` documents to ``date, gbp_to_usd``.

    A day without USD keeps its row, with a null rate.
    """
    return (
        responses.select(F.from_json("value", RATE_RESPONSE).alias("response"))
        .select(F.explode("response.rates").alias("day", "by_currency"))
        .select(
            F.to_date("day").alias("date"),
            F.col("by_currency").getItem("USD").alias("gbp_to_usd"),
        )
    )


def latest_rate(rates: DataFrame, fallback: float = STREAM_FALLBACK_RATE) -> DataFrame:
    """One row: the rate of the last published day, or ``fallback`` if there is none."""
    last = F.max_by("gbp_to_usd", "date")
    return rates.agg(F.coalesce(last, F.lit(fallback)).alias("gbp_to_usd"))
