from __future__ import annotations

import datetime as dt

import pytest
from rows import raw_line, raw_orders, rates

from tillbook.operators import clean

MONDAY = dt.date(2009, 12, 7)


def cleaned(spark, *lines, fx=(), **options):
    return clean.clean_orders(raw_orders(spark, *lines), rates(spark, *fx), **options)


@pytest.mark.parametrize(
    ("code", "kept"),
    [
        ("POST", False),
        ("D", False),
        ("M", False),
        (None, False),
        ("BANK CHARGES", True),
        ("C2", True),
        ("85123A", True),
        ("", True),
    ],
)
def test_stock_code_filter(spark, code, kept):
    raw = raw_orders(spark, raw_line(code=code))
    assert clean.drop_bad_rows(raw).count() == int(kept)


def test_extra_bad_codes(spark):
    raw = raw_orders(spark, raw_line(code="BANK CHARGES"), raw_line(code="C2"))
    left = clean.drop_bad_rows(raw, extra_bad_codes=["BANK CHARGES"]).collect()
    assert [row["StockCode"] for row in left] == ["C2"]


@pytest.mark.parametrize("customer", [None, float("nan")])
def test_line_without_customer_is_dropped(spark, customer):
    assert cleaned(spark, raw_line(customer=customer)).count() == 0


@pytest.mark.parametrize(
    ("customer", "text"), [(13085.0, "13085"), (12.9, "12"), (3_000_000_000.0, "3000000000")]
)
def test_customer_id_text(spark, customer, text):
    assert cleaned(spark, raw_line(customer=customer)).first()["customer_id"] == text


@pytest.mark.parametrize(
    ("invoice", "flag"), [("C489", True), ("c489", False), ("489", False), (None, None)]
)
def test_cancelled_flag(spark, invoice, flag):
    assert cleaned(spark, raw_line(invoice=invoice)).first()["is_cancelled"] is flag


def test_rate_of_the_same_day_only(spark):
    lines = [raw_line(when=dt.datetime(2009, 12, day, 23, 59)) for day in (5, 7)]
    fx = [(dt.date(2009, 12, 4), 1.25), (MONDAY, 2.0)]
    rows = cleaned(spark, *lines, fx=fx).orderBy("invoice_date").collect()
    assert [row["gbp_to_usd"] for row in rows] == [1.5, 2.0]


def test_null_rate_and_custom_fallback(spark):
    result = cleaned(spark, raw_line(), fx=[(MONDAY, None)], fallback_rate=1.75)
    assert result.first()["gbp_to_usd"] == 1.75


def test_line_without_date_gets_the_fallback(spark):
    row = cleaned(spark, raw_line(when=None), fx=[(None, 9.0), (None, 8.0)]).first()
    assert (row["invoice_date"], row["gbp_to_usd"]) == (None, 1.5)


def test_total_usd_is_rounded_from_total_gbp(spark):
    row = cleaned(spark, raw_line(quantity=100, price=0.07), fx=[(MONDAY, 1.25)]).first()
    assert row["unit_price_usd"] == 0.09
    assert row["total_amount_usd"] == 8.75


def test_second_rate_for_a_day_is_an_error(spark):
    result = cleaned(spark, raw_line(), fx=[(MONDAY, 1.25), (MONDAY, 1.5)])
    with pytest.raises(Exception, match="more than one rate for 2009-12-07"):
        result.collect()


def test_columns(spark):
    assert cleaned(spark, raw_line()).columns == [
        "invoice_no", "stock_code", "description", "quantity", "invoice_date",
        "unit_price_gbp", "customer_id", "country", "is_cancelled", "total_amount_gbp",
        "gbp_to_usd", "unit_price_usd", "total_amount_usd",
    ]
