"""Reading lake tables and landing raw orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.schemas import RAW_ORDERS


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; give the schema where it is known, to skip reading footers for it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_orders_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw order lines from CSV files with a header, every column as text."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_ORDERS])
    return spark.read.schema(text).option("header", True).csv(path)


def time_from_nanos(name: str) -> Column:
    """A column of nanoseconds since 1970 as a timestamp."""
    return F.timestamp_micros(F.expr(f"`{name}` div 1000"))


def land_orders(source: DataFrame) -> DataFrame:
    """Raw orders in their fixed types; text ``nan`` means missing.

    Parquet files with nanosecond times are read under ``spark.sql.legacy.parquet.nanosAsLong``,
    which makes them numbers; they become timestamps here.
    """
    types = dict(source.dtypes)

    def landed(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType) and types[field.name] == "bigint":
            return time_from_nanos(field.name).alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.nullif(column.cast("string"), F.lit("nan")).alias(field.name)
        return column.cast(field.dataType).alias(field.name)

    return source.select(*(landed(field) for field in RAW_ORDERS))
