"""Revenue by region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions.orders import region


def revenue_by_region(orders: DataFrame) -> DataFrame:
    """Lines and USD revenue per region, from one pass over the lines.

    Lines are summed by country first, so only a few rows are left to be given a region.
    """
    usd = F.col("total_amount_usd").cast("decimal(28,2)")
    by_country = orders.groupBy("country").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(usd).alias("usd")
    )
    return by_country.groupBy(region(F.col("country")).alias("region")).agg(
        F.sum("lines").alias("line_count"),
        F.sum("usd").cast("double").alias("revenue_usd"),
    )
