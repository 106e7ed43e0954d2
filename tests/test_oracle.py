"""Every query against its SQL, and the fixture figures."""

from __future__ import annotations

import pytest
from compare import connect, duckdb_rows, duckdb_types, spark_rows, spark_types
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tillbook.plans.catalog import QUERIES, _cleaned, _enriched
from tillbook.plans.oracles import ORACLES
from tillbook.sources import fixtures

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    sql = spark_entry.oracle_sql()[name]
    result = spark_entry.queries()[name](spark, sf_dir)
    assert spark_types(result) == duckdb_types(con, sql)
    assert spark_rows(result) == duckdb_rows(con, sql)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries())


def test_an_unknown_nation_keeps_its_lines(spark, sf_dir, tmp_path):
    for name in ("orders", "lineitem", "part"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    nation = F.when(F.col("c_custkey") % 3 == 0, 99).otherwise(F.col("c_nationkey"))
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    customers.withColumn("c_nationkey", nation).write.parquet(f"{tmp_path}/customer.parquet")
    lines = fixtures.raw_orders(spark, str(tmp_path))
    assert lines.count() == fixtures.raw_orders(spark, sf_dir).count()
    assert lines.filter("Country IS NULL").count() > 0


def test_entry(spark):
    assert {row["region"] for row in spark_entry.entry(spark).collect()} == {
        "UK",
        "Europe",
        "Rest of World",
    }


def test_order_figures(spark):
    assert fixtures.raw_orders(spark, MIDDLE).count() == 60_000
    rates = fixtures.fx_rates(spark, MIDDLE)
    low, high, days = rates.selectExpr(
        "min(gbp_to_usd)", "max(gbp_to_usd)", "count(distinct date)"
    ).first()
    assert (low, high, days, rates.count()) == (1.25, 1.734375, 1715, 1715)
    figures = (
        _cleaned(spark, MIDDLE)
        .selectExpr(
            "count(*) lines",
            "count_if(is_cancelled) cancelled",
            "count_if(gbp_to_usd = 1.5) at_fallback",
            "count(distinct customer_id) customers",
            "count(distinct stock_code) codes",
            "count(distinct country) countries",
            "count_if(stock_code = 'BANK CHARGES') charges",
            "sum(total_amount_gbp) gbp",
            "round(sum(total_amount_usd), 2) usd",
        )
        .first()
    )
    assert tuple(figures) == (
        43_952, 893, 13_734, 1_125, 1_901, 25, 1_179, 110_033_335.5, 164_356_394.63
    )


def test_event_figures(spark):
    figures = (
        _enriched(spark, MIDDLE)
        .selectExpr(
            "count(*)",
            "count_if(quantity < 0)",
            "count_if(quantity * unit_price > 5000)",
            "count_if(is_anomaly)",
            "count(distinct stock_code)",
            "count(distinct invoice_no)",
        )
        .first()
    )
    assert tuple(figures) == (10_000, 2_014, 1_632, 3_646, 100, 6_616)
