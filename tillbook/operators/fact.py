"""The order-line fact table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillbook.functions.calendar import date_key
from tillbook.operators.accounting import sort_lines
from tillbook.operators.keys import assign_dense_key
from tillbook.staging import stage

BROADCAST_BYTES = 256 * 1024 * 1024
# Rough cost of a hashed row beside its text key.
_ROW_BYTES = 64

# The warehouse table's columns, in its order.
FACT_COLUMNS = (
    "order_key",
    "invoice_no",
    "customer_key",
    "product_key",
    "date_key",
    "country_key",
    "quantity",
    "unit_price_gbp",
    "unit_price_usd",
    "total_amount_gbp",
    "total_amount_usd",
    "exchange_rate",
    "is_cancelled",
    "is_anomaly",
    "event_timestamp",
)

# Invoice and stock code first; then every exported column these do not already settle, so
# that a rerun gives each line the same key.
FACT_ORDER = (
    "invoice_no",
    "stock_code",
    "customer_key",
    "country_key",
    "event_timestamp",
    "quantity",
    "unit_price_gbp",
    "unit_price_usd",
    "total_amount_gbp",
    "total_amount_usd",
    "exchange_rate",
    "is_cancelled",
)


def measured_bytes(tables: Sequence[tuple[DataFrame, str]]) -> list[int]:
    """Size of each key table when broadcast, by its text key; one small job for all."""
    sizes = [
        table.agg(
            F.lit(place).alias("place"),
            (F.coalesce(F.sum(F.octet_length(key)), F.lit(0)) + F.count(F.lit(1)) * _ROW_BYTES)
            .cast("long")
            .alias("bytes"),
        )
        for place, (table, key) in enumerate(tables)
    ]
    measured = reduce(DataFrame.unionAll, sizes).collect()
    return [row["bytes"] for row in sorted(measured, key=lambda row: row["place"])]


def lookup_keys(
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_country: DataFrame,
    broadcast_limit: int = BROADCAST_BYTES,
    counts: Observation | None = None,
) -> tuple[DataFrame, bool]:
    """Inner-join the three surrogate keys; also tell whether no join needed a shuffle.

    With ``counts``, lines without a key are found by left joins, and counted as they are dropped.

    The key tables are broadcast from the smallest on while all of them together stay within
    ``broadcast_limit``. The others go through a shuffle join, where adaptive execution
    splits the partition of a hot key.
    """
    lookups = (
        (dim_country, "country_name", "country_key", "country"),
        (dim_product, "stock_code", "product_key", "stock_code"),
        (dim_customer, "customer_id", "customer_key", "customer_id"),
    )
    sizes = measured_bytes([(dim, business_key) for dim, business_key, _, _ in lookups])
    total = 0
    for size, place in sorted(zip(sizes, range(len(lookups)), strict=True)):
        dim, business_key, surrogate, column = lookups[place]
        keys = dim.select(F.col(business_key).alias(column), surrogate)
        total += size
        if total <= broadcast_limit:
            keys = F.broadcast(keys)
        orders = orders.join(keys, column, "inner" if counts is None else "left")
    if counts is not None:
        reasons = {
            f"no {surrogate.removesuffix('_key')}": F.col(surrogate).isNull()
            for _, _, surrogate, _ in lookups
        }
        orders = sort_lines(orders, reasons, counts)
    return orders, total <= broadcast_limit


def build_fact_orders(
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_country: DataFrame,
    stored: bool = False,
    broadcast_limit: int = BROADCAST_BYTES,
    counts: Observation | None = None,
) -> DataFrame:
    """One row per order line whose customer, product and country are all known.

    ``counts`` gets the number of lines kept and of those without a country, product or customer;
    the lines are staged for it, as the key sort would run their plan twice.

    Pass ``stored=True`` when ``orders`` is a scan of stored files: it then goes straight
    into the key sort. Anything else, and the result of a shuffle join, is staged first,
    because copies of a line are told apart by their place in a file.
    """
    lines, all_broadcast = lookup_keys(
        orders, dim_customer, dim_product, dim_country, broadcast_limit, counts
    )
    lines = lines.select(
        "invoice_no",
        "stock_code",
        "customer_key",
        "product_key",
        date_key(F.col("invoice_date")).alias("date_key"),
        "country_key",
        "quantity",
        "unit_price_gbp",
        "unit_price_usd",
        "total_amount_gbp",
        "total_amount_usd",
        F.col("gbp_to_usd").alias("exchange_rate"),
        "is_cancelled",
        F.lit(False).alias("is_anomaly"),
        F.col("invoice_date").alias("event_timestamp"),
    )
    source = orders
    if not (stored and all_broadcast) or counts is not None:
        source = lines = stage(lines, "fact_lines")
    keyed = assign_dense_key(
        lines,
        FACT_ORDER,
        "order_key",
        "long",
        spread_copies=True,
        rows=source.count(),  # of stored files, which takes their footers only
    )
    return keyed.select(*FACT_COLUMNS)
