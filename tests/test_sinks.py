from __future__ import annotations

import pytest
from rows import cleaned_line, cleaned_orders, event, events

from tillbook.operators.events import enrich_events, parse_events
from tillbook.operators.metrics import window_metrics
from tillbook.operators.profile import over_length
from tillbook.sinks import warehouse
from tillbook.sinks.lake import write_partitions, write_table
from tillbook.sinks.topic import kafka_sink_options, write_events_to_folder
from tillbook.sources.fixtures import order_messages

URL = "jdbc:postgresql://db/shop"


def test_write_table_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_write_partitions_replaces_only_its_own(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, "p")
    write_partitions(spark.createDataFrame([(3, "b")], "v int, p string"), path, "p")
    rows = {tuple(row) for row in spark.read.parquet(path).select("v", "p").collect()}
    assert rows == {(1, "a"), (3, "b")}


def test_events_folder_round_trip(spark, tmp_path):
    path = str(tmp_path / "messages")
    rows = [event(), event(invoice="2")]
    write_events_to_folder(order_messages(events(spark, *rows)), path)
    read = parse_events(spark.read.text(path))
    assert sorted(tuple(row) for row in read.collect()) == sorted(rows)


def test_kafka_options():
    options = kafka_sink_options("host:9092", "orders.raw")
    assert options["topic"] == "orders.raw"
    assert options["kafka.bootstrap.servers"] == "host:9092"


@pytest.fixture
def writes(spark, monkeypatch):
    """Records the JDBC writes, as there is no warehouse to write to."""
    calls = []

    class Writer:
        def __init__(self, df):
            self.call = {"df": df}

        def format(self, name):
            self.call["format"] = name
            return self

        def options(self, **options):
            self.call["options"] = options
            return self

        def mode(self, mode):
            self.call["mode"] = mode
            return self

        def save(self):
            calls.append(self.call)

    monkeypatch.setattr(type(spark.range(1)), "write", property(Writer))
    return calls


def test_write_jdbc(spark, writes):
    lines = enrich_events(events(spark, event()), 1.25)
    metrics = window_metrics(lines)
    warehouse.write_jdbc(metrics, "realtime_metrics", URL, {"user": "u"}, connections=3)
    (call,) = writes
    assert (call["format"], call["mode"]) == ("jdbc", "append")
    assert call["options"]["dbtable"] == "realtime_metrics"
    assert call["options"]["numPartitions"] == "3"
    assert call["options"]["user"] == "u"
    types = dict(call["df"].dtypes)
    assert types["total_revenue_gbp"] == "decimal(12,2)"
    assert types["order_count"] == "int"
    assert call["df"].columns == metrics.columns


def test_refresh_star_order_and_truncation(spark, writes):
    tables = {name: spark.range(1) for name in warehouse.STAR_ORDER}
    tables["fact_orders"] = cleaned_orders(spark, cleaned_line()).withColumnRenamed(
        "gbp_to_usd", "exchange_rate"
    )
    tables["dim_customer"] = spark.range(1).withColumnRenamed("id", "total_orders")
    tables["dim_product"] = spark.range(1).withColumnRenamed("id", "avg_price_gbp")
    warehouse.refresh_star(tables, URL, {})
    assert [call["options"]["dbtable"] for call in writes] == list(warehouse.STAR_ORDER)
    assert writes[-1]["options"]["dbtable"] == "fact_orders"
    for call in writes:
        assert call["mode"] == "overwrite"
        assert call["options"]["truncate"] == "true"
        assert call["options"]["cascadeTruncate"] == "true"
    assert dict(writes[-1]["df"].dtypes)["exchange_rate"] == "decimal(10,6)"


def test_refresh_needs_every_table(spark):
    with pytest.raises(ValueError, match="fact_orders"):
        warehouse.refresh_star({"dim_date": spark.range(1)}, URL, {})


def test_cascade_is_for_postgresql_only():
    assert "cascadeTruncate" not in warehouse.refresh_options("jdbc:h2:x", "t", {})


def test_amount_that_does_not_fit_is_an_error(spark):
    product = spark.createDataFrame([(1e12,)], "avg_price_gbp double")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        warehouse.warehouse_columns(product, "dim_product").collect()


def test_over_length(spark):
    orders = cleaned_orders(spark, cleaned_line(description="x" * 501), cleaned_line())
    assert over_length(orders, {"description": 500, "customer_id": 50}).count() == 1
