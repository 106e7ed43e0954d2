"""Comparing a Spark result with the same query in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def plain_rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    """Rows as text, columns by name, in a fixed order."""
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in places) for row in rows)


def spark_rows(df) -> list[tuple[str, ...]]:
    return plain_rows(df.columns, df.collect())


def duckdb_rows(con, sql: str) -> list[tuple[str, ...]]:
    result = con.execute(sql)
    return plain_rows([c[0] for c in result.description], result.fetchall())


# How a Spark type is called in DuckDB.
TYPE_NAMES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def spark_types(df) -> dict[str, str]:
    return {name: TYPE_NAMES.get(kind, kind) for name, kind in df.dtypes}


def duckdb_types(con, sql: str) -> dict[str, str]:
    return {row[0]: str(row[1]) for row in con.execute(f"DESCRIBE {sql}").fetchall()}
