"""Order events as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillbook.functions.calendar import event_time, iso_text
from tillbook.functions.orders import float_text, in_usd, is_anomaly
from tillbook.schemas import (
    EVENT_TIME_FORMAT,
    ORDER_EVENT,
    REPLAY_ROWS,
    STREAM_FALLBACK_RATE,
)

# What ``sort_out_events`` adds to an event.
MESSAGE = "_message"
REASON = "_reason"


def to_event_json(raw: DataFrame) -> DataFrame:
    """Raw invoice lines as JSON text in ``value``.

    Missing descriptions and customers become empty text, and a customer ID keeps its
    decimal point (``13085.0``).
    """
    customer = F.nanvl(F.col("Customer ID"), F.lit(None))
    event = F.struct(
        F.col("Invoice").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        F.coalesce("Description", F.lit("")).alias("description"),
        F.col("Quantity").cast("int").alias("quantity"),
        iso_text(F.col("InvoiceDate")).alias("invoice_date"),
        F.col("Price").cast("double").alias("unit_price"),
        F.coalesce(float_text(customer), F.lit("")).alias("customer_id"),
        F.col("Country").alias("country"),
    )
    return raw.select(F.to_json(event, {"ignoreNullFields": "false"}).alias("value"))


def replay_slice(raw: DataFrame, mode: str = "test") -> DataFrame:
    """The lines a replay sends: the first hundred by time in ``test``, all in ``full``."""
    if mode not in REPLAY_ROWS:
        raise ValueError(f"replay mode must be one of {sorted(REPLAY_ROWS)}, not {mode!r}")
    rows = REPLAY_ROWS[mode]
    if rows is None:
        return raw
    first = ["InvoiceDate", "Invoice", "StockCode"]
    rest = [c for c in raw.columns if c not in first]
    return raw.orderBy(*(F.col(c).asc_nulls_last() for c in first + rest)).limit(rows)


def parse_events(messages: DataFrame) -> DataFrame:
    """Binary or text JSON in ``value`` to event columns; what cannot be read is null."""
    return messages.select(
        F.from_json(F.col("value").cast("string"), ORDER_EVENT).alias("event")
    ).select("event.*")


def sort_out_events(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Like ``parse_events``, with the message's text and why it could not be read.

    The reason is null for an event. ``empty``: no text, or white space. ``not an object``: text
    that is no JSON object, or one cut off before any field. ``no fields``: an object without a
    value for any field of an event. With ``strict``, ``unreadable field`` is one too: a field has
    another type, or the text breaks off behind some fields; otherwise, as in ``parse_events``,
    such an event keeps what could be read.
    """
    broken = "_broken"
    schema = StructType([*ORDER_EVENT.fields, StructField(broken, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    text = F.col("value").cast("string")
    parsed = messages.select(
        text.alias(MESSAGE), F.from_json(text, schema, options).alias("event")
    ).select(MESSAGE, "event.*")
    nothing = F.coalesce(*(F.col(name).cast("string") for name in ORDER_EVENT.names)).isNull()
    reason = (
        F.when(F.coalesce(F.trim(MESSAGE), F.lit("")) == "", "empty")
        .when(nothing & F.col(broken).isNotNull(), "not an object")
        .when(nothing, "no fields")
    )
    if strict:
        reason = reason.when(F.col(broken).isNotNull(), "unreadable field")
    return parsed.select(*ORDER_EVENT.names, MESSAGE, reason.alias(REASON))


def flag_anomaly(events: DataFrame) -> DataFrame:
    return events.withColumn("is_anomaly", is_anomaly(F.col("quantity"), F.col("unit_price")))


def enrich_events(
    events: DataFrame, rate: float = STREAM_FALLBACK_RATE, fractional: bool = False
) -> DataFrame:
    """Timestamps, USD unit price and anomaly flag; the same for batch and stream."""
    parsed = event_time(F.col("invoice_date"), EVENT_TIME_FORMAT, fractional)
    return flag_anomaly(
        events.withColumns(
            {
                "invoice_date": parsed,
                "unit_price_usd": in_usd(F.col("unit_price"), F.lit(rate)),
            }
        )
    )
