from __future__ import annotations

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillbook.operators import keys
from tillbook.operators.keys import assign_dense_key, continue_dense_key


def with_row_number(df, order):
    window = Window.orderBy(*(F.col(c).asc_nulls_first() for c in order))
    return df.withColumn("expected", F.row_number().over(window))


def test_equals_global_row_number(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("k"), F.xxhash64("id").cast("string")).alias("k"), "id"
    )
    keyed = assign_dense_key(with_row_number(df, ["k"]), ["k"], "key")
    assert keyed.filter("key <> expected").count() == 0
    assert keyed.count() == 5000
    assert dict(keyed.dtypes)["key"] == "int"


def test_null_comes_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    rows = assign_dense_key(df, ["k"], "key", "long").collect()
    assert {row["k"]: row["key"] for row in rows} == {None: 1, "a": 2, "b": 3}


def test_empty(spark):
    df = spark.createDataFrame([], "k string")
    assert assign_dense_key(df, ["k"], "key").count() == 0


def partition_sizes(monkeypatch, *args, **options):
    """Rows per partition of the staged key sort."""
    staged = []

    def capture(df, label):
        staged.append(df.groupBy(F.shiftright(keys._SLOT, 33).alias("p")).count().collect())
        return stage(df, label)

    stage = keys.stage
    monkeypatch.setattr(keys, "stage", capture)
    result = assign_dense_key(*args, **options)
    return result, sorted(row["count"] for row in staged[0])


def test_hot_first_column_is_cut(spark, monkeypatch):
    df = spark.range(60_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("hot").alias("a"),
        F.col("id").alias("b"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed, sizes = partition_sizes(
            monkeypatch, with_row_number(df, ["a", "b"]), ["a", "b"], "key"
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert keyed.filter("key <> expected").count() == 0
    assert len(sizes) == 4
    assert sizes[-1] < 20_000


def test_copies_are_cut(spark, monkeypatch):
    df = spark.range(40_000, numPartitions=4).select(F.lit("same").alias("a"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed, sizes = partition_sizes(monkeypatch, df, ["a"], "key", spread_copies=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert keyed.columns == ["a", "key"]
    low, high, distinct = keyed.selectExpr("min(key)", "max(key)", "count(distinct key)").first()
    assert (low, high, distinct) == (1, 40_000, 40_000)
    assert len(sizes) == 4
    assert sizes[-1] < 14_000


def test_known_row_count_sizes_the_sort(spark, monkeypatch):
    df = spark.range(3000).select((-F.col("id")).alias("a"))
    keyed, sizes = partition_sizes(monkeypatch, df, ["a"], "key", rows=3000, rows_per_partition=334)
    assert len(sizes) == 9
    assert keyed.filter("key <> a + 3000").count() == 0
    _, sizes = partition_sizes(monkeypatch, df, ["a"], "key", rows=300, rows_per_partition=100)
    assert len(sizes) <= 4


def customers(spark, *names):
    return spark.createDataFrame([(n, f"about {n}") for n in names], "customer string, about string")


def keys_of(df):
    return {row["customer"]: row["key"] for row in df.collect()}


def test_known_keys_go_on(spark):
    none = spark.createDataFrame([], "customer string, about string, key int")
    first = continue_dense_key(customers(spark, "m", "c", None), none, "customer", "key")
    plain = assign_dense_key(customers(spark, "m", "c", None), ["customer"], "key")
    assert keys_of(first) == keys_of(plain) == {None: 1, "c": 2, "m": 3}
    # A customer that comes first in the order renumbers nobody, and one that is gone stays.
    second = continue_dense_key(customers(spark, "a", "m", "z", None), first, "customer", "key")
    assert keys_of(second) == {None: 1, "c": 2, "m": 3, "a": 4, "z": 5}
    third = continue_dense_key(customers(spark, "c", "b"), second, "customer", "key")
    assert keys_of(third) == {None: 1, "c": 2, "m": 3, "a": 4, "z": 5, "b": 6}
    again = continue_dense_key(customers(spark, "c", "b"), third, "customer", "key")
    assert sorted(map(str, again.collect())) == sorted(map(str, third.collect()))
    assert dict(third.dtypes)["key"] == "int"


def test_keys_are_never_given_twice(spark):
    known = spark.createDataFrame([("a", "", 7), ("b", "", 3)], "customer string, about string, key int")
    found = keys_of(continue_dense_key(customers(spark, "d", "c"), known, "customer", "key"))
    assert found == {"a": 7, "b": 3, "c": 8, "d": 9}


def test_repeated_known_rows_are_an_error(spark):
    schema = "customer string, about string, key int"
    same_key = spark.createDataFrame([("a", "", 1), ("b", "", 1)], schema)
    with pytest.raises(ValueError, match="repeated"):
        continue_dense_key(customers(spark, "a"), same_key, "customer", "key")
    same_name = spark.createDataFrame([("a", "", 1), ("a", "", 2)], schema)
    with pytest.raises(Exception, match="more than one row for a"):
        continue_dense_key(customers(spark, "a", "b"), same_name, "customer", "key").collect()
