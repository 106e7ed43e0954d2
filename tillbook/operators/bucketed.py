"""Key lookup in a dimension that is too large to broadcast, without a shuffle of the order lines.

Order lines and dimension are stored in the same number of buckets by the business key, so a
bucket of lines joins its bucket of keys. The lines of a hot key would make one bucket large;
they are stored apart and joined with the broadcast rows of the hot keys, of which there can be
no more than buckets.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Bucketed(NamedTuple):
    """A table in buckets, and where its hot keys' rows are."""

    path: str
    column: str
    buckets: int
    schema: T.StructType
    hot: tuple[str, ...]


def _write(df: DataFrame, path: str, column: str, buckets: int) -> None:
    # A table's name lives in the session only; the files carry their bucket's number.
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, column)
    writer = dealt.write.bucketBy(buckets, column).sortBy(column).option("path", path)
    writer.format("parquet").mode("overwrite").saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


def write_bucketed(
    df: DataFrame, path: str, column: str, buckets: int, split_hot: bool = True
) -> Bucketed:
    """Store ``df`` in buckets by ``column``, the rows of hot keys apart.

    A key is hot if more rows have it than an even bucket holds; there are fewer such keys than
    buckets. ``df`` is read twice and should be stored. A dimension has one row for each key and
    nothing to split.
    """
    hot: list = []
    if split_hot:
        counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        share = df.count() / buckets
        many = counts.filter((F.col("n") > share) & F.col(column).isNotNull())
        hot = sorted(row[column] for row in many.collect())
    is_hot = F.coalesce(F.col(column).isin(hot), F.lit(False))
    _write(df.filter(~is_hot), f"{path}/buckets", column, buckets)
    df.filter(is_hot).write.mode("overwrite").parquet(f"{path}/hot")
    return Bucketed(path, column, buckets, df.schema, tuple(hot))


def open_buckets(spark: SparkSession, table: Bucketed) -> DataFrame:
    """The rows in buckets, known as such to this session's planner."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{table.column}`) "
        f"SORTED BY (`{table.column}`) INTO {table.buckets} BUCKETS LOCATION '{table.path}/buckets'"
    )
    return spark.table(name)


def lookup_bucketed(spark: SparkSession, orders: Bucketed, dim: Bucketed, key: str) -> DataFrame:
    """The order lines with the surrogate ``key`` of ``dim``; lines without one are dropped."""
    if orders.buckets != dim.buckets or dim.hot:
        raise ValueError("give both sides the same number of buckets, and a whole dimension")
    business = F.col(dim.column).alias(orders.column)
    keys = open_buckets(spark, dim).select(business, key)
    # Ask for a join by buckets even where the statistics would broadcast the keys.
    cold = open_buckets(spark, orders).join(keys.hint("merge"), orders.column)
    hot_lines = spark.read.schema(orders.schema).parquet(f"{orders.path}/hot")
    hot_keys = keys.filter(F.col(orders.column).isin(list(orders.hot)))
    hot = hot_lines.join(F.broadcast(hot_keys), orders.column)
    return cold.unionByName(hot)
