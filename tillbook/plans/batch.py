"""The batch jobs, from landed sources to the star schema.

All tables live under one lake folder: ``raw/orders``, ``raw/exchange_rates``,
``processed/cleaned_orders`` and ``curated/<star table>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillbook.operators.clean import clean_orders
from tillbook.operators.dims import dim_country, dim_customer, dim_date, dim_product
from tillbook.operators.fact import build_fact_orders
from tillbook.schemas import RATES, RAW_ORDERS
from tillbook.sinks.lake import write_table
from tillbook.sources.rates import flatten_rates
from tillbook.sources.tables import land_orders, read_table
from tillbook.staging import stage, staged_until_done
from tillbook.streaming.files import exists

DIMENSIONS = {
    "dim_customer": dim_customer,
    "dim_country": dim_country,
    "dim_product": dim_product,
    "dim_date": dim_date,
}


def raw_orders(spark: SparkSession, lake: str) -> DataFrame:
    return read_table(spark, f"{lake}/raw/orders", RAW_ORDERS)


def exchange_rates(spark: SparkSession, lake: str) -> DataFrame:
    return read_table(spark, f"{lake}/raw/exchange_rates", RATES)


def star_table(spark: SparkSession, lake: str, name: str) -> DataFrame:
    return read_table(spark, f"{lake}/curated/{name}")


def land(orders: DataFrame, rate_responses: DataFrame, lake: str) -> None:
    """Write the raw tables."""
    write_table(land_orders(orders), f"{lake}/raw/orders")
    write_table(flatten_rates(rate_responses), f"{lake}/raw/exchange_rates")


def clean(spark: SparkSession, lake: str) -> None:
    """Write the cleaned orders."""
    cleaned = clean_orders(raw_orders(spark, lake), exchange_rates(spark, lake))
    write_table(cleaned, f"{lake}/processed/cleaned_orders")


def build_star(
    spark: SparkSession, lake: str, keep_keys: bool = False
) -> dict[str, DataFrame]:
    """Write the five star tables, each once.

    The fact joins the written dimensions, so lake and warehouse get the same keys. With
    ``keep_keys``, customers, countries and products that the lake's dimensions have already keep
    their keys, and those that have no orders any more stay in them.
    """
    orders = read_table(spark, f"{lake}/processed/cleaned_orders")
    tables = {}
    with staged_until_done(spark):
        for name, build in DIMENSIONS.items():
            path = f"{lake}/curated/{name}"
            if keep_keys and name != "dim_date" and exists(spark, path):
                # A copy, as the table itself is about to be replaced.
                rows = build(orders, stage(star_table(spark, lake, name), name))
                rows = stage(rows, name)
            else:
                rows = build(orders)
            write_table(rows, path)
            tables[name] = star_table(spark, lake, name)
        fact = build_fact_orders(
            orders,
            tables["dim_customer"],
            tables["dim_product"],
            tables["dim_country"],
            stored=True,
        )
        write_table(fact, f"{lake}/curated/fact_orders")
    tables["fact_orders"] = star_table(spark, lake, "fact_orders")
    return tables


def run_batch(
    spark: SparkSession, orders: DataFrame, rate_responses: DataFrame, lake: str
) -> dict[str, DataFrame]:
    """Land orders and rates, clean, then build the star."""
    land(orders, rate_responses, lake)
    clean(spark, lake)
    return build_star(spark, lake)
