"""From raw invoice lines to cleaned, USD-priced order lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillbook.functions.orders import customer_id_text, in_usd, is_cancelled, is_product
from tillbook.operators.accounting import sort_lines
from tillbook.schemas import BATCH_FALLBACK_RATE


def drop_bad_rows(
    raw: DataFrame, extra_bad_codes: Iterable[str] = (), counts: Observation | None = None
) -> DataFrame:
    """Keep lines with a customer and a product code.

    Works on the raw columns, so the null test is pushed into the Parquet scan. With ``counts``,
    lines are counted by what becomes of them, for which all have to be read.
    """
    customer = F.col("Customer ID")
    if counts is not None:
        reasons = {
            "no customer": customer.isNull() | F.isnan(customer),
            "no stock code": F.col("StockCode").isNull(),
            "not a product": ~is_product(F.col("StockCode"), extra_bad_codes),
        }
        return sort_lines(raw, reasons, counts)
    return raw.filter(
        customer.isNotNull()
        & ~F.isnan(customer)
        & is_product(F.col("StockCode"), extra_bad_codes)
    )


def standardize(raw: DataFrame) -> DataFrame:
    """Snake-case names, and the customer ID as whole-number text."""
    return raw.select(
        F.col("Invoice").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        F.col("Description").alias("description"),
        F.col("Quantity").alias("quantity"),
        F.col("InvoiceDate").alias("invoice_date"),
        F.col("Price").alias("unit_price_gbp"),
        customer_id_text(F.col("Customer ID")).alias("customer_id"),
        F.col("Country").alias("country"),
    )


def flag_cancelled(orders: DataFrame) -> DataFrame:
    return orders.withColumn("is_cancelled", is_cancelled(F.col("invoice_no")))


def add_totals(orders: DataFrame) -> DataFrame:
    return orders.withColumn("total_amount_gbp", F.col("quantity") * F.col("unit_price_gbp"))


def rate_per_day(rates: DataFrame) -> DataFrame:
    """``join_date, gbp_to_usd`` with one row per day; a day given twice is an error.

    A second rate for a day would double that day's order lines. The check also bounds the
    table: the calendar has under four million days, so it can always be broadcast.
    """
    repeated = F.concat(F.lit("more than one rate for "), F.col("join_date").cast("string"))
    return (
        rates.select(F.to_date("date").alias("join_date"), "gbp_to_usd")
        .filter(F.col("join_date").isNotNull())
        .groupBy("join_date")
        .agg(F.max("gbp_to_usd").alias("rate"), F.count(F.lit(1)).alias("given"))
        .select(
            "join_date",
            F.when(F.col("given") > 1, F.raise_error(repeated))
            .otherwise(F.col("rate"))
            .alias("gbp_to_usd"),
        )
    )


def enrich_fx(
    orders: DataFrame, rates: DataFrame, fallback_rate: float = BATCH_FALLBACK_RATE
) -> DataFrame:
    """Add the rate of the order's own day, or ``fallback_rate`` where none was published."""
    daily = F.broadcast(rate_per_day(rates))
    return (
        orders.withColumn("join_date", F.to_date("invoice_date"))
        .join(daily, "join_date", "left")
        .withColumn("gbp_to_usd", F.coalesce("gbp_to_usd", F.lit(fallback_rate)))
        .drop("join_date")
    )


def add_usd(orders: DataFrame) -> DataFrame:
    """Unit and total USD, each rounded from its own GBP amount."""
    rate = F.col("gbp_to_usd")
    return orders.withColumns(
        {
            "unit_price_usd": in_usd(F.col("unit_price_gbp"), rate),
            "total_amount_usd": in_usd(F.col("total_amount_gbp"), rate),
        }
    )


def clean_orders(
    raw: DataFrame,
    rates: DataFrame,
    fallback_rate: float = BATCH_FALLBACK_RATE,
    extra_bad_codes: Iterable[str] = (),
    counts: Observation | None = None,
) -> DataFrame:
    """The whole cleaning job: one scan and one broadcast join, with no shuffle of orders.

    ``counts`` gets the number of lines kept and dropped by reason once the result is written.
    """
    lines = standardize(drop_bad_rows(raw, extra_bad_codes, counts))
    lines = add_totals(flag_cancelled(lines))
    return add_usd(enrich_fx(lines, rates, fallback_rate))
