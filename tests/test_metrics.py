from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from rows import event, events

import pytest

from tillbook.operators.events import enrich_events
from tillbook.operators.metrics import top_country, top_product, upsert, window_metrics

START = dt.datetime(2024, 1, 1)


def lines_of(spark, rows):
    return enrich_events(events(spark, *rows), 1.25)


def random_events(count, seed):
    pick = random.Random(seed)
    for i in range(count):
        when = START + dt.timedelta(seconds=pick.randrange(3600))
        yield event(
            invoice=pick.choice([None, *map(str, range(40))]),
            code=pick.choice([None, "A", "B", "C", "D"]),
            quantity=pick.choice([None, -3, 0, 1, 2, 3]),
            when=pick.choice([None, *[when.isoformat()] * 20]),
            price=pick.choice([None, 0.07, 2.5, 19.99]),
            country=pick.choice([None, "EIRE", "France", "USA"]),
        )


def leader(totals):
    """Highest total, unknown totals last, names in order; nothing if there is no name."""
    names = [name for name in totals if name is not None]
    if not names:
        return None
    return min(names, key=lambda n: (totals[n] is None, -(totals[n] or 0), n))


def rounded(value):
    return None if value is None else value.quantize(Decimal("0.01"), ROUND_HALF_UP)


def brute_force(rows, rate=Decimal("1.25")):
    windows = defaultdict(list)
    for row in rows:
        if row[4] is not None:
            seconds = int((dt.datetime.fromisoformat(row[4]) - START).total_seconds())
            windows[START + dt.timedelta(seconds=seconds // 300 * 300)].append(row)
    found = {}
    for start, lines in windows.items():
        gbp, usd, units, orders = [], [], {}, defaultdict(set)
        for invoice, code, _, quantity, _, price, _, country in lines:
            if quantity is not None and price is not None:
                gbp.append(quantity * Decimal(str(price)))
                usd.append(quantity * rounded(Decimal(str(price)) * rate))
            units.setdefault(code, None)
            if quantity is not None:
                units[code] = (units[code] or 0) + quantity
            orders[country].update([invoice] if invoice else [])
        found[start] = (
            start + dt.timedelta(minutes=5),
            len({line[0] for line in lines} - {None}),
            rounded(sum(gbp)) if gbp else None,
            rounded(sum(usd)) if usd else None,
            rounded(sum(gbp) / len(gbp)) if gbp else None,
            leader(units),
            leader({name: len(invoices) for name, invoices in orders.items()}),
        )
    return found


def by_window(df):
    return {row["window_start"]: tuple(row)[1:] for row in df.collect()}


def test_equals_brute_force(spark):
    rows = list(random_events(600, seed=1))
    expected = brute_force(rows)
    lines = lines_of(spark, rows)
    assert by_window(window_metrics(lines)) == expected
    assert by_window(top_product(lines)) == {w: (m[5],) for w, m in expected.items()}
    assert by_window(top_country(lines)) == {w: (m[6],) for w, m in expected.items()}


def test_sparse_windows_equal_brute_force(spark):
    rows = [row for seed in range(30) for row in random_events(2, seed)]
    assert by_window(window_metrics(lines_of(spark, rows))) == brute_force(rows)


def test_price_that_is_no_number_has_no_amount(spark):
    rows = [event(quantity=2), event(price=float("nan")), event(invoice="2", price=None)]
    row = window_metrics(lines_of(spark, rows)).first()
    assert (row["order_count"], row["total_revenue_gbp"], row["avg_order_value"]) == (2, 20, 20)


def test_small_amounts_are_not_cut(spark):
    row = window_metrics(lines_of(spark, [event(quantity=1, price=0.00004)] * 1000)).first()
    assert row["total_revenue_gbp"] == Decimal("0.04")


@pytest.mark.parametrize("price", [1e15, 1e28, 1e300, float("inf")])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_huge_amounts(spark, price, ansi):
    rows = [event(quantity=1, price=price), event(invoice="2", quantity=1, price=1.0)]
    rows.append(event(when="2024-01-01T00:07:00", quantity=2, price=3.0))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        first, second = window_metrics(lines_of(spark, rows)).orderBy("window_start").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert first["order_count"] == 2
    assert first["total_revenue_gbp"] == (10**15 + 1 if price == 1e15 else None)
    assert second["total_revenue_gbp"] == 6


def test_a_total_beyond_the_decimals_is_null(spark):
    rows = [event(invoice=str(i), quantity=1, price=9e27) for i in range(30)]
    row = window_metrics(lines_of(spark, rows)).first()
    assert (row["order_count"], row["total_revenue_gbp"], row["avg_order_value"]) == (30, None, None)


def test_ties_go_to_the_first_name(spark):
    rows = [
        event(invoice="1", code="B", quantity=2, country="USA"),
        event(invoice="2", code="A", quantity=1, country="EIRE"),
        event(invoice="2", code="A", quantity=1, country="EIRE"),
    ]
    row = window_metrics(lines_of(spark, rows)).first()
    assert (row["top_product_code"], row["top_country"]) == ("A", "EIRE")


def test_upsert(spark):
    old = window_metrics(
        lines_of(spark, [event(), event(when="2024-01-01T00:05:00", price=1.0)])
    )
    new = window_metrics(
        lines_of(
            spark,
            [
                event(when="2024-01-01T00:05:00", price=2.0),
                event(when="2024-01-01T00:10:00", price=3.0),
            ],
        )
    )
    revenue = {
        row["window_start"].minute: row["total_revenue_gbp"]
        for row in upsert(old, new).collect()
    }
    assert revenue == {0: 10, 5: 2, 10: 3}


def test_upsert_reads_each_side_once(spark):
    old, new = (window_metrics(lines_of(spark, [event()])) for _ in range(2))
    plan = upsert(old, new)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Union") == 1
