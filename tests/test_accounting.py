from __future__ import annotations

import math

from pyspark.sql import Observation
from rows import cleaned_line, cleaned_orders, raw_line, raw_orders, rates

from tillbook.operators.clean import clean_orders, drop_bad_rows
from tillbook.operators.fact import build_fact_orders
from tillbook.staging import stage


def test_cleaning_counts_every_line_once(spark):
    raw = raw_orders(
        spark,
        raw_line(), raw_line(code="C2"), raw_line(code=""),
        raw_line(customer=None), raw_line(customer=math.nan), raw_line(customer=None, code="POST"),
        raw_line(code=None), raw_line(code="POST"), raw_line(code="M"), raw_line(code="BAD"),
    )
    counts = Observation()
    kept = stage(clean_orders(raw, rates(spark), counts=counts), "cleaned")
    assert counts.get == {"no customer": 3, "no stock code": 1, "not a product": 3, "kept": 3}
    assert sum(counts.get.values()) == raw.count()
    plain = clean_orders(raw, rates(spark))
    assert kept.exceptAll(plain).count() == plain.exceptAll(kept).count() == 0
    more = Observation()
    stage(drop_bad_rows(raw, ["C2"], more), "kept")
    assert (more.get["not a product"], more.get["kept"]) == (4, 2)


def test_counting_needs_no_second_scan(spark, tmp_path):
    raw_orders(spark, raw_line(), raw_line(customer=None)).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    plan = clean_orders(raw, rates(spark), counts=Observation())._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan parquet") == 1
    assert "CollectMetrics" in plan.toString()


def test_key_lookup_counts_every_line_once(spark):
    orders = stage(
        cleaned_orders(
            spark,
            cleaned_line(), cleaned_line(), cleaned_line(customer="8"), cleaned_line(code="Z"),
            cleaned_line(country="Mars"), cleaned_line(country=None), cleaned_line(country=None, code="Z"),
            cleaned_line(customer=None),
        ),
        "orders",
    )
    customers = spark.createDataFrame([("7", 1)], "customer_id string, customer_key int")
    products = spark.createDataFrame([("A1", 1)], "stock_code string, product_key int")
    countries = spark.createDataFrame([("France", 1)], "country_name string, country_key int")
    dims = (customers, products, countries)
    plain = build_fact_orders(orders, *dims, stored=True)
    for limit in (1 << 28, 0):
        counts = Observation()
        fact = build_fact_orders(orders, *dims, stored=True, broadcast_limit=limit, counts=counts)
        assert counts.get == {"no country": 3, "no product": 1, "no customer": 2, "kept": 2}
        assert fact.exceptAll(plain).count() == plain.exceptAll(fact).count() == 0
