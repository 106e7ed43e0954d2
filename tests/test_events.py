from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from rows import event, events, raw_line, raw_orders

from tillbook.functions.orders import normalize_customer_id
from tillbook.operators.events import (
    enrich_events,
    flag_anomaly,
    parse_events,
    replay_slice,
    to_event_json,
)
from tillbook.sources.fixtures import order_messages


def encoded(spark, **line):
    return json.loads(to_event_json(raw_orders(spark, raw_line(**line))).first()["value"])


def test_event_json(spark):
    assert encoded(spark) == {
        "invoice_no": "489434",
        "stock_code": "85123A",
        "description": "LANTERN",
        "quantity": 2,
        "invoice_date": "2009-12-07T12:00:00",
        "unit_price": 2.5,
        "customer_id": "13085.0",
        "country": "France",
    }


def test_event_json_of_missing_values(spark):
    found = encoded(spark, description=None, customer=None, country=None, invoice=None)
    assert (found["description"], found["customer_id"]) == ("", "")
    assert found["country"] is None and "country" in found
    assert found["invoice_no"] is None
    assert encoded(spark, customer=float("nan"))["customer_id"] == ""


@pytest.mark.parametrize("customer", [13085.0, 12345678.0, 0.0, 13085.5])
def test_customer_text_is_that_of_a_float(spark, customer):
    assert encoded(spark, customer=customer)["customer_id"] == str(customer)


@pytest.mark.parametrize("micros", [0, 500_000, 1])
def test_event_time_is_iso(spark, micros):
    when = dt.datetime(2009, 12, 7, 12, 0, 5, micros)
    assert encoded(spark, when=when)["invoice_date"] == when.isoformat()


def test_messages_are_parsed_back(spark):
    rows = [event(), event(code=None, quantity=-3, customer="")]
    parsed = parse_events(order_messages(events(spark, *rows)))
    assert [tuple(row) for row in parsed.collect()] == rows


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_unreadable_messages(spark, kind):
    texts = ["not json", '{"quantity": "x", "country": "EIRE", "extra": 1}', None]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = parse_events(messages.select(F.col("value").cast(kind))).collect()
    assert set(rows[0]) == {None}
    assert rows[1]["quantity"] is None and rows[1]["country"] == "EIRE"
    assert set(rows[2]) == {None}


@pytest.mark.parametrize(
    ("quantity", "price", "flag"),
    [
        (1, 10.0, False),
        (-1, 10.0, True),
        (500, 10.0, False),
        (501, 10.0, True),
        (None, 10.0, False),
        (1, None, False),
        (-1, None, True),
    ],
)
def test_anomaly(spark, quantity, price, flag):
    flagged = flag_anomaly(events(spark, event(quantity=quantity, price=price)))
    assert flagged.first()["is_anomaly"] is flag


def test_enrich(spark):
    row = enrich_events(events(spark, event(price=10.03))).first()
    assert row["invoice_date"] == dt.datetime(2024, 1, 1)
    assert row["unit_price_usd"] == 12.74
    assert enrich_events(events(spark, event(price=10.0)), 1.5).first()["unit_price_usd"] == 15


@pytest.mark.parametrize(
    ("text", "fractional", "parsed"),
    [
        ("2024-01-01T10:00:00", False, dt.datetime(2024, 1, 1, 10)),
        ("2024-01-01T10:00:00.500000", False, None),
        ("2024-01-01T10:00:00.500000", True, dt.datetime(2024, 1, 1, 10, 0, 0, 500_000)),
        ("bad", False, None),
        ("bad", True, None),
        (None, True, None),
    ],
)
def test_event_time(spark, text, fractional, parsed):
    row = enrich_events(events(spark, event(when=text)), fractional=fractional).first()
    assert row["invoice_date"] == parsed


def test_normalized_customer_id(spark):
    texts = ["13085.0", "", None, "abc", "12345678.0"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    found = [row[0] for row in df.select(normalize_customer_id(F.col("c"))).collect()]
    assert found == ["13085", None, None, None, "12345678"]


def test_replay(spark):
    start = dt.datetime(2010, 1, 1)
    lines = [
        raw_line(invoice=str(i), when=start + dt.timedelta(minutes=i)) for i in range(150)
    ]
    raw = raw_orders(spark, *reversed(lines))
    assert sorted(int(r["Invoice"]) for r in replay_slice(raw).collect()) == list(range(100))
    assert replay_slice(raw, "full").count() == 150
    with pytest.raises(ValueError, match="replay mode"):
        replay_slice(raw, "half")
