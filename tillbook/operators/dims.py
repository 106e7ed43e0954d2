"""The four dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions.calendar import date_key, day_name, monday_based_weekday, month_name
from tillbook.functions.orders import currency, region
from tillbook.operators.keys import assign_dense_key, continue_dense_key
from tillbook.schemas import PRODUCT_CATEGORY, RFM_SEGMENT

# What unit prices are summed as; a price that does not fit is an error.
PRICE = "decimal(28,10)"


def _keyed(rows: DataFrame, known: DataFrame | None, business: str, name: str) -> DataFrame:
    """Rows with their surrogate key, going on from the keys of an earlier run if there are any."""
    if known is None:
        return assign_dense_key(rows, [business], name)
    return continue_dense_key(rows, known, business, name)


def dim_customer(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per customer; cancelled invoices count too.

    With ``known``, an earlier customer dimension, its keys stay, see ``continue_dense_key``.
    """
    # Text maxima cannot be hash-aggregated, so countries become groups first: the order
    # lines are only hashed, down to a customer's countries and invoices.
    columns = ("customer_id", "country", "invoice_no")
    pieces = (
        orders.select(*columns, F.to_date("invoice_date").alias("day"))
        .groupingSets([["customer_id", "country"], ["customer_id", "invoice_no"]], *columns)
        .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    )
    customers = pieces.groupBy("customer_id").agg(
        F.max("country").alias("country"),
        F.min("first_day").alias("first_purchase_date"),
        F.max("last_day").alias("last_purchase_date"),
        F.count("invoice_no").alias("total_orders"),
    )
    keyed = _keyed(customers, known, "customer_id", "customer_key")
    return keyed.withColumn("rfm_segment", F.lit(RFM_SEGMENT))


def dim_product(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per stock code; the keys of ``known`` stay."""
    # As above: descriptions are groups while there are many lines. Prices are summed as
    # decimals, so that the average does not depend on the order of the lines.
    priced = orders.select(
        "stock_code", "description", F.col("unit_price_gbp").cast(PRICE).alias("price")
    )
    described = priced.groupBy("stock_code", "description").agg(
        F.sum("price").alias("price_sum"), F.count("price").alias("priced")
    )
    mean = F.try_divide(F.sum("price_sum"), F.sum("priced"))
    products = described.groupBy("stock_code").agg(
        F.max("description").alias("description"),
        F.round(mean, 2).cast("double").alias("avg_price_gbp"),
    )
    keyed = _keyed(products, known, "stock_code", "product_key")
    return keyed.withColumn("category", F.lit(PRODUCT_CATEGORY))


def country_regions(orders: DataFrame) -> DataFrame:
    """Distinct countries, a null one included, with region and currency."""
    name = F.col("country_name")
    return (
        orders.select(F.col("country").alias("country_name"))
        .distinct()
        .withColumns({"region": region(name), "currency_code": currency(name)})
    )


def dim_country(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per country; the keys of ``known`` stay."""
    return _keyed(country_regions(orders), known, "country_name", "country_key")


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day that has an order line."""
    day = F.col("full_date")
    weekday = monday_based_weekday(day)
    return (
        orders.select(F.to_date("invoice_date").alias("full_date"))
        .distinct()
        .select(
            day,
            date_key(day).alias("date_key"),
            weekday.alias("day_of_week"),
            day_name(day).alias("day_name"),
            F.month(day).cast("short").alias("month"),
            month_name(day).alias("month_name"),
            F.quarter(day).cast("short").alias("quarter"),
            F.year(day).cast("short").alias("year"),
            weekday.isin(5, 6).alias("is_weekend"),
        )
    )
