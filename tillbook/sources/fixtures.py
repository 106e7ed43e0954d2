"""The test tables mapped onto raw orders, rates and order events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.schemas import EUROPE, HOME_COUNTRY, ORDER_EVENT

# The names of nations 0 to 24.
COUNTRIES = (
    HOME_COUNTRY, *EUROPE[:18], "USA", "Japan", "Australia", "RSA", "Brazil", "Unspecified",
)
RATE_EPOCH = "1995-01-02"
EVENT_RATE = 1.25
DAMAGED_EVERY = 101


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _country(index: Column) -> Column:
    """The country of a nation; null for an unknown one."""
    return F.get(F.array(*(F.lit(name) for name in COUNTRIES)), index.cast("int"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw order line per line item."""
    customers = _table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    orders = _table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    parts = _table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    lines = (
        _table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )
    returned = F.col("l_orderkey") % 50 == 0
    part = F.col("l_partkey")
    suffix = F.when(part % 5 == 0, "A").otherwise("")
    quantity = F.col("l_quantity").cast("long")
    return lines.select(
        F.concat(F.when(returned, "C").otherwise(""), F.col("l_orderkey").cast("string")).alias(
            "Invoice"
        ),
        F.when(part % 40 == 0, "POST")
        .when(part % 40 == 1, "BANK CHARGES")
        .otherwise(F.concat(part.cast("string"), suffix))
        .alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.when(returned, -quantity).otherwise(quantity).alias("Quantity"),
        F.col("o_orderdate").cast("timestamp").alias("InvoiceDate"),
        (F.col("p_size") * 4 + F.lit(0.25)).cast("double").alias("Price"),
        F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey").cast("double")).alias(
            "Customer ID"
        ),
        _country(F.col("c_nationkey")).alias("Country"),
    )


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate for every order date that is a weekday."""
    day = F.to_date("o_orderdate")
    since = F.datediff("date", F.lit(RATE_EPOCH).cast("date"))
    return (
        _table(spark, sf_dir, "orders", "o_orderdate")
        .select(day.alias("date"))
        .distinct()
        .filter((since + 7) % 7 < 5)
        .select("date", (F.lit(1.25) + (since % 32) / F.lit(64.0)).alias("gbp_to_usd"))
    )


def rate_responses(rates: DataFrame) -> DataFrame:
    """Rates as response documents, one per month, in ``value``; a null rate has no USD."""
    quoted = F.create_map(F.lit("USD"), F.col("gbp_to_usd"))
    unquoted = F.map_filter(quoted, lambda _, rate: rate.isNotNull())
    day = F.struct(F.col("date").cast("string"), unquoted)
    return (
        rates.groupBy(F.trunc("date", "month").alias("month"))
        .agg(F.map_from_entries(F.collect_list(day)).alias("rates"))
        .select(F.to_json(F.struct("rates")).alias("value"))
    )


def order_events(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """One order event per row of ``events``, beside ``extra`` columns of it."""
    events = _table(
        spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props"
    )
    error = F.col("event_type") == "error"
    units = (F.col("event_id") % 12 + 1).cast("int")
    return events.select(
        F.concat(
            F.when(error, "C").otherwise(""), F.expr("event_id div 2").cast("string")
        ).alias("invoice_no"),
        F.get_json_object("props", "$.k").alias("stock_code"),
        F.col("event_type").alias("description"),
        F.when(error, -units).otherwise(units).alias("quantity"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("invoice_date"),
        (F.floor(F.col("value") * 4) / 4 * 10).cast("double").alias("unit_price"),
        F.concat(F.col("user_id").cast("string"), F.lit(".0")).alias("customer_id"),
        _country(F.col("user_id") % len(COUNTRIES)).alias("country"),
        *extra,
    )


def order_messages(events: DataFrame) -> DataFrame:
    """Order events as JSON messages in ``value``."""
    fields = F.struct(*ORDER_EVENT.names)
    return events.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of all order events, six of every ``DAMAGED_EVERY`` damaged in six ways."""
    invoice = F.col("invoice_no")
    kind = F.col("event_id") % DAMAGED_EVERY
    whole = F.to_json(F.struct(*ORDER_EVENT.names), {"ignoreNullFields": "false"})
    text = (
        F.when(kind == 0, "")
        .when(kind == 1, F.concat(F.lit("order "), invoice))
        .when(kind == 2, F.concat(F.lit('{"order": "'), invoice, F.lit('"}')))
        .when(kind == 3, F.concat(F.lit('{"invoice_no": "'), invoice))
        .when(kind == 4, F.lit(None).cast("string"))
        .when(kind == 5, F.concat(F.lit('{"invoice_no": "'), invoice, F.lit('", "quantity": "x"}')))
        .otherwise(whole)
    )
    return order_events(spark, sf_dir, "event_id").select(text.alias("value"))
