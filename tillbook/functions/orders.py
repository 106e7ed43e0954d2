"""Columns that describe an order line."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillbook.schemas import (
    ANOMALY_AMOUNT,
    CANCELLED_PREFIX,
    EUROPE,
    HOME_COUNTRY,
    NON_PRODUCT_CODE,
)


def is_product(stock_code: Column, extra_bad_codes: Iterable[str] = ()) -> Column:
    """False for purely alphabetic codes and ``extra_bad_codes``; null for a null code."""
    product = ~stock_code.rlike(NON_PRODUCT_CODE)
    extra = list(extra_bad_codes)
    return product & ~stock_code.isin(extra) if extra else product


def is_cancelled(invoice_no: Column) -> Column:
    return invoice_no.startswith(CANCELLED_PREFIX)


def is_anomaly(quantity: Column, unit_price: Column) -> Column:
    """A return, or a line above the threshold amount; unknown values are no anomaly."""
    odd = (quantity < 0) | (quantity * unit_price > ANOMALY_AMOUNT)
    return F.coalesce(odd, F.lit(False))


def in_usd(amount_gbp: Column, rate: Column) -> Column:
    return F.round(amount_gbp * rate, 2)


def by_region(country: Column, home: str, europe: str, elsewhere: str) -> Column:
    """One of three labels; an unknown country counts as elsewhere."""
    return (
        F.when(country == HOME_COUNTRY, home)
        .when(country.isin(*EUROPE), europe)
        .otherwise(elsewhere)
    )


def region(country: Column) -> Column:
    return by_region(country, "UK", "Europe", "Rest of World")


def currency(country: Column) -> Column:
    return by_region(country, "GBP", "EUR", "USD")


def customer_id_text(customer_id: Column) -> Column:
    """A numeric customer ID as whole-number text: 13085.0 becomes 13085."""
    return customer_id.try_cast("bigint").cast("string")


def float_text(number: Column) -> Column:
    """A double as decimal text that keeps one fractional digit: 13085 becomes 13085.0."""
    whole = F.concat(number.try_cast("bigint").cast("string"), F.lit(".0"))
    plain = (number == F.floor(number)) & (F.abs(number) < 1e16)
    return F.when(plain, whole).otherwise(number.cast("string"))


def normalize_customer_id(customer_id: Column) -> Column:
    """Event customer text (``13085.0`` or empty) in the form the dimensions use."""
    return customer_id_text(customer_id.try_cast("double"))
