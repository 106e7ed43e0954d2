"""Small hand-made tables."""

from __future__ import annotations

import datetime as dt

from tillbook.schemas import ORDER_EVENT, RATES, RAW_ORDERS

NOON = dt.datetime(2009, 12, 7, 12, 0)


def raw_line(
    invoice="489434",
    code="85123A",
    description="LANTERN",
    quantity=2,
    when=NOON,
    price=2.5,
    customer=13085.0,
    country="France",
):
    return (invoice, code, description, quantity, when, price, customer, country)


def raw_orders(spark, *lines):
    return spark.createDataFrame(list(lines), RAW_ORDERS)


def rates(spark, *rows):
    return spark.createDataFrame(list(rows), RATES)


CLEANED = (
    "invoice_no string, stock_code string, description string, quantity long, "
    "invoice_date timestamp, unit_price_gbp double, customer_id string, country string, "
    "is_cancelled boolean, total_amount_gbp double, gbp_to_usd double, "
    "unit_price_usd double, total_amount_usd double"
)


def cleaned_line(
    invoice="1", code="A1", description="x", quantity=1, when=NOON, price=1.0,
    customer="7", country="France",
):
    total = quantity * price
    return (
        invoice, code, description, quantity, when, price, customer, country,
        invoice.startswith("C"), total, 1.5, price * 1.5, total * 1.5,
    )


def cleaned_orders(spark, *lines):
    return spark.createDataFrame(list(lines), CLEANED)


def event(
    invoice="1", code="A", description="d", quantity=1, when="2024-01-01T00:00:00",
    price=10.0, customer="7.0", country="France",
):
    return (invoice, code, description, quantity, when, price, customer, country)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), ORDER_EVENT)
