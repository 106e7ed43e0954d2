"""Physical plans that must hold whatever the size of the data."""

from __future__ import annotations

import pytest
from rows import raw_line, raw_orders, rates

from tillbook.operators import clean, dims, fact, keys, metrics
from tillbook.plans.catalog import _enriched
from tillbook.schemas import RATES, RAW_ORDERS
from tillbook.session import new_folder, shared_folder
from tillbook.sources.tables import read_table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    raw_orders(spark, raw_line()).write.parquet(str(tmp_path / "raw"))
    rates(spark).write.parquet(str(tmp_path / "rates"))
    return (
        read_table(spark, str(tmp_path / "raw"), RAW_ORDERS),
        read_table(spark, str(tmp_path / "rates"), RATES),
    )


@pytest.fixture
def plans_staged(monkeypatch):
    """Plans of the tables that the key sort stages."""
    plans = []
    stage = keys.stage

    def capture(df, label):
        plans.append(plan_of(df))
        return stage(df, label)

    monkeypatch.setattr(keys, "stage", capture)
    return plans


def test_cleaning_does_not_shuffle_orders(stored):
    plan = plan_of(clean.clean_orders(*stored))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(join_date" in plan
    assert "BroadcastHashJoin" in plan
    assert "PushedFilters: [IsNotNull(StockCode), IsNotNull(`Customer ID`)]" in plan


def test_dimensions_hash_the_order_lines(stored, plans_staged):
    orders = clean.clean_orders(*stored)
    for build in (dims.dim_customer, dims.dim_product, dims.dim_country):
        build(orders)
    for plan in plans_staged:
        # The aggregate nearest the scan, the last in the text, sees every order line.
        aggregates = [line for line in plan.split("\n") if "Aggregate(" in line]
        lines = [line for line in aggregates if "join_date" not in line]
        assert "HashAggregate" in lines[-1]
        assert "Window" not in plan
        assert "SinglePartition" not in plan


def test_dimensions_read_only_their_columns(stored, plans_staged):
    orders = clean.clean_orders(*stored)
    dims.dim_country(orders)
    (plan,) = plans_staged
    assert "ReadSchema: struct<StockCode:string,Customer ID:double,Country:string>" in plan
    assert "Join" not in plan


def test_fact_is_one_range_shuffle(spark, stored, plans_staged, tmp_path):
    clean.clean_orders(*stored).write.parquet(str(tmp_path / "cleaned"))
    orders = read_table(spark, str(tmp_path / "cleaned"))
    tables = []
    for build in (dims.dim_customer, dims.dim_product, dims.dim_country):
        path = str(tmp_path / build.__name__)
        build(orders).write.parquet(path)
        tables.append(read_table(spark, path))
    plans_staged.clear()
    fact.build_fact_orders(orders, *tables, stored=True)
    (plan,) = plans_staged
    assert plan.count("rangepartitioning") == 1
    assert plan.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in plan
    assert "hashpartitioning" not in plan


def test_metrics_hash_the_lines_in_one_scan(spark, sf_dir):
    plan = plan_of(metrics.window_metrics(_enriched(spark, sf_dir)))
    assert plan.count("FileScan") == 1
    aggregates = [line for line in plan.split("\n") if "Aggregate(" in line]
    assert "HashAggregate" in aggregates[-1]
    assert "SinglePartition" not in plan


class Session:
    """Only the settings of a session."""

    def __init__(self, **settings):
        self.settings = {key.replace("__", "."): value for key, value in settings.items()}

    @property
    def conf(self):
        return self.settings


def test_shared_folder_comes_from_the_session():
    session = Session(spark__checkpoint__dir="hdfs://shared/checkpoints/", spark__master="yarn")
    assert shared_folder(session) == "hdfs://shared/checkpoints"
    assert new_folder(session, "x").startswith("hdfs://shared/checkpoints/x-")
    assert new_folder(session, "x") != new_folder(session, "x")


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(spark__master="yarn"))


def test_local_mode_may_do_without():
    session = Session(spark__master="local[4]", spark__sql__warehouse__dir="/w/house")
    assert shared_folder(session) == "/w/house/_staged"
