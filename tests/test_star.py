from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from rows import cleaned_line, cleaned_orders

from tillbook.operators.dims import dim_country, dim_customer, dim_date, dim_product
from tillbook.operators.fact import (
    FACT_COLUMNS,
    build_fact_orders,
    lookup_keys,
    measured_bytes,
)
from tillbook.plans import catalog
from tillbook.plans.batch import build_star, run_batch
from tillbook.plans.catalog import _cleaned
from tillbook.sources import fixtures
from tillbook.staging import stage


def by(df, column):
    return {row[column]: row for row in df.collect()}


def test_dim_customer(spark):
    orders = cleaned_orders(
        spark,
        cleaned_line(invoice="1", customer="7", country="France"),
        cleaned_line(invoice="1", customer="7", country="France", code="B"),
        cleaned_line(invoice="C2", customer="7", country="Spain", when=dt.datetime(2010, 1, 2)),
        cleaned_line(invoice="3", customer="12", country="EIRE"),
        cleaned_line(invoice="4", customer="13", country=None),
    )
    customers = by(dim_customer(orders), "customer_id")
    seven = customers["7"]
    assert seven["country"] == "Spain"
    assert seven["first_purchase_date"] == dt.date(2009, 12, 7)
    assert seven["last_purchase_date"] == dt.date(2010, 1, 2)
    assert seven["total_orders"] == 2
    assert seven["rfm_segment"] == "Active"
    assert customers["13"]["country"] is None
    assert [customers[c]["customer_key"] for c in ("12", "13", "7")] == [1, 2, 3]


def test_invoice_in_two_countries_counts_once(spark):
    orders = cleaned_orders(
        spark, cleaned_line(country="France"), cleaned_line(country="Spain")
    )
    assert dim_customer(orders).first()["total_orders"] == 1


def test_dim_product(spark):
    orders = cleaned_orders(
        spark,
        cleaned_line(code="B", description="apple", price=1.0),
        cleaned_line(code="B", description="pear", price=1.25),
        cleaned_line(code="B", description=None, price=1.0),
        cleaned_line(code="A", description=None, price=2.0),
    )
    products = by(dim_product(orders), "stock_code")
    assert (products["B"]["description"], products["B"]["avg_price_gbp"]) == ("pear", 1.08)
    assert products["A"]["description"] is None
    assert (products["A"]["product_key"], products["B"]["product_key"]) == (1, 2)
    assert products["A"]["category"] == "General"


def test_dim_country(spark):
    names = ["United Kingdom", "EIRE", "Iceland", "USA", None]
    orders = cleaned_orders(spark, *(cleaned_line(country=name) for name in names))
    found = {
        row["country_name"]: (row["region"], row["currency_code"], row["country_key"])
        for row in dim_country(orders).collect()
    }
    assert found == {
        None: ("Rest of World", "USD", 1),
        "EIRE": ("Europe", "EUR", 2),
        "Iceland": ("Europe", "EUR", 3),
        "USA": ("Rest of World", "USD", 4),
        "United Kingdom": ("UK", "GBP", 5),
    }


def test_dim_date(spark):
    orders = cleaned_orders(
        spark,
        cleaned_line(when=dt.datetime(2009, 12, 6, 8)),
        cleaned_line(when=dt.datetime(2009, 12, 6, 20)),
        cleaned_line(when=dt.datetime(2009, 12, 7, 8)),
    )
    dates = by(dim_date(orders), "date_key")
    sunday, monday = dates[20091206], dates[20091207]
    assert (sunday["day_of_week"], sunday["day_name"], sunday["is_weekend"]) == (
        6, "Sunday", True
    )
    assert (monday["day_of_week"], monday["day_name"], monday["is_weekend"]) == (
        0, "Monday", False
    )
    assert (monday["month"], monday["month_name"], monday["quarter"], monday["year"]) == (
        12, "December", 4, 2009
    )


@pytest.fixture(scope="module")
def star_inputs(spark, sf_dir):
    orders = stage(_cleaned(spark, sf_dir), "orders")
    return orders, dim_customer(orders), dim_product(orders), dim_country(orders)


def test_fact_invariants(star_inputs):
    orders, customers, products, countries = star_inputs
    fact = build_fact_orders(*star_inputs, stored=True)
    rows = orders.count()
    assert tuple(fact.columns) == FACT_COLUMNS
    assert fact.selectExpr("min(order_key)", "max(order_key)", "count(distinct order_key)").first() == (
        1, rows, rows
    )
    assert fact.agg(F.sum("total_amount_gbp")).first() == orders.agg(
        F.sum("total_amount_gbp")
    ).first()
    for dim, key in ((customers, "customer_key"), (products, "product_key"), (countries, "country_key")):
        assert fact.join(dim, key, "left_anti").count() == 0
    assert not fact.filter("is_anomaly").count()


def test_order_keys_do_not_change_in_a_rerun_or_with_shuffle_joins(star_inputs):
    once = build_fact_orders(*star_inputs, stored=True)
    again = build_fact_orders(*star_inputs)
    shuffled = build_fact_orders(*star_inputs, stored=True, broadcast_limit=0)
    for other in (again, shuffled):
        assert once.exceptAll(other).count() == 0
        assert other.count() == once.count()


def test_hot_customer_is_split_in_a_shuffle_join(spark, monkeypatch):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key) for key in settings}
    spread = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(
            "customer_id"
        ),
        F.col("id").cast("string").alias("invoice_no"),
        F.lit("A").alias("stock_code"),
        F.lit("France").alias("country"),
    )
    customers = spread.select("customer_id").distinct()
    customers = stage(customers.withColumn("customer_key", F.xxhash64("customer_id")), "c")
    products = spark.createDataFrame([("A", 1)], "stock_code string, product_key int")
    countries = spark.createDataFrame([("France", 1)], "country_name string, country_key int")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined, all_broadcast = lookup_keys(
            spread, customers, products, countries, broadcast_limit=1000
        )
        assert not all_broadcast
        assert joined.groupBy("customer_key").count().agg(F.max("count")).first()[0] == 13_334
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(rows) == 40_000
    assert "SortMergeJoin(skew=true)" in plan


def test_key_tables_share_one_broadcast_budget(spark):
    orders = cleaned_orders(spark, cleaned_line())
    tables = (dim_customer(orders), dim_product(orders), dim_country(orders))
    sizes = measured_bytes(
        list(zip(tables, ("customer_id", "stock_code", "country_name"), strict=True))
    )
    for limit, wanted in ((sum(sizes), True), (sum(sizes) - 1, False), (max(sizes), False)):
        _, all_broadcast = lookup_keys(orders, *tables, broadcast_limit=limit)
        assert all_broadcast is wanted


def test_average_price_does_not_depend_on_order(spark):
    lines = [cleaned_line(price=p) for p in (0.1, 0.2, 0.3, 1e9, 0.005, 2.675)] * 20
    found = set()
    for parts in (1, 3, 7):
        orders = cleaned_orders(spark, *lines).repartition(parts)
        found.add(tuple(dim_product(orders).first()))
        lines.reverse()
    assert len(found) == 1


def test_line_without_known_country_is_left_out(spark):
    orders = cleaned_orders(spark, cleaned_line(country=None), cleaned_line(invoice="2"))
    fact = build_fact_orders(
        orders, dim_customer(orders), dim_product(orders), dim_country(orders)
    )
    assert [(row["order_key"], row["invoice_no"]) for row in fact.collect()] == [(1, "2")]


def test_copies_of_a_line_all_stay(spark):
    orders = cleaned_orders(spark, *[cleaned_line()] * 50)
    fact = build_fact_orders(
        orders, dim_customer(orders), dim_product(orders), dim_country(orders)
    )
    assert sorted(row["order_key"] for row in fact.collect()) == list(range(1, 51))


def test_batch_run_writes_every_table_and_drops_its_stages(spark, sf_dir, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr("tillbook.session.shared_folder", lambda spark: str(shared))
    raw = fixtures.raw_orders(spark, sf_dir)
    responses = fixtures.rate_responses(fixtures.fx_rates(spark, sf_dir))
    star = run_batch(spark, raw, responses, str(tmp_path / "lake"))
    assert {p.name for p in (tmp_path / "lake" / "curated").iterdir()} == set(star)
    assert not list(shared.iterdir())
    direct = _cleaned(spark, sf_dir)
    written = spark.read.parquet(str(tmp_path / "lake/processed/cleaned_orders"))
    assert written.exceptAll(direct).count() == 0
    assert star["fact_orders"].count() == direct.count()

    once = {name: {tuple(row) for row in table.collect()} for name, table in star.items()}
    again = build_star(spark, str(tmp_path / "lake"))
    assert {name: {tuple(row) for row in table.collect()} for name, table in again.items()} == once


def test_sums_of_a_batch_run_may_exceed_a_bigint(spark, monkeypatch):
    fact = spark.createDataFrame(
        [(2**40, 2**22, 1, 1, 1.5)] * 8,
        "order_key long, customer_key int, product_key int, country_key int, total_amount_usd double",
    )
    monkeypatch.setattr(catalog, "run_batch", lambda *_: {"fact_orders": fact})
    monkeypatch.setattr(catalog.fixtures, "raw_orders", lambda *_: None)
    monkeypatch.setattr(catalog.fixtures, "fx_rates", lambda *_: None)
    monkeypatch.setattr(catalog.fixtures, "rate_responses", lambda *_: None)
    row = catalog.batch_run(spark, "").first()
    assert row["key_sum"] == float(8 * 2**40 * (2**22 + 2)) > 2**63
    assert (row["row_count"], row["value_sum"]) == (8, 12.0)
