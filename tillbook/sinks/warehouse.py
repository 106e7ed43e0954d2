"""The star schema and live metrics in a relational warehouse, over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.schemas import WAREHOUSE_TYPES

# Dimensions first, so that the keys a fact row points to exist when it arrives.
STAR_ORDER = ("dim_customer", "dim_country", "dim_product", "dim_date", "fact_orders")


def warehouse_columns(df: DataFrame, table: str) -> DataFrame:
    """Cast to the warehouse's column types; an amount that does not fit is an error."""
    types = WAREHOUSE_TYPES.get(table, {})
    return df.withColumns({name: F.col(name).cast(to) for name, to in types.items()})


def jdbc_options(
    url: str, table: str, properties: Mapping[str, str], connections: int = 8
) -> dict[str, str]:
    """Writer options; ``connections`` bounds how many tasks write at a time."""
    return {
        "batchsize": "10000",
        **properties,
        "url": url,
        "dbtable": table,
        "numPartitions": str(connections),
    }


def write_jdbc(
    df: DataFrame, table: str, url: str, properties: Mapping[str, str], connections: int = 8
) -> None:
    """Append to a warehouse table."""
    options = jdbc_options(url, table, properties, connections)
    warehouse_columns(df, table).write.format("jdbc").options(**options).mode("append").save()


def refresh_options(
    url: str, table: str, properties: Mapping[str, str], connections: int = 8
) -> dict[str, str]:
    """Options that empty the table and keep its definition.

    PostgreSQL also empties the tables that refer to it.
    """
    options = jdbc_options(url, table, properties, connections)
    options["truncate"] = "true"
    if url.startswith("jdbc:postgresql:"):
        options["cascadeTruncate"] = "true"
    return options


def refresh_table(
    df: DataFrame, table: str, url: str, properties: Mapping[str, str], connections: int = 8
) -> None:
    """Empty and reload one table, such as the live metrics."""
    options = refresh_options(url, table, properties, connections)
    warehouse_columns(df, table).write.format("jdbc").options(**options).mode(
        "overwrite"
    ).save()


def refresh_star(
    tables: Mapping[str, DataFrame],
    url: str,
    properties: Mapping[str, str],
    connections: int = 8,
) -> None:
    """Empty and reload all five tables.

    The load is not one transaction: readers see empty tables until it is done.
    """
    missing = [name for name in STAR_ORDER if name not in tables]
    if missing:
        raise ValueError(f"missing tables: {', '.join(missing)}")
    for name in STAR_ORDER:
        refresh_table(tables[name], name, url, properties, connections)
