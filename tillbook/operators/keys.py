"""Dense surrogate keys without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.staging import stage

# Rows that one task sorts without much spilling.
ROWS_PER_PARTITION = 5_000_000

_COPY = "_copy"
_SLOT = "_slot"
# As documented, monotonically_increasing_id holds the partition in its upper 31 bits and the
# row within it in the lower 33.
_PARTITION_BIT = 33


def _sort_partitions(df: DataFrame, rows: int | None, rows_per_partition: int) -> list[int]:
    """A partition count where ``rows`` asks for more than the session's default, else none."""
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-(rows or 0) // rows_per_partition)
    return [wanted] if wanted > default else []


def assign_dense_key(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    key_type: str = "int",
    spread_copies: bool = False,
    rows: int | None = None,
    rows_per_partition: int = ROWS_PER_PARTITION,
) -> DataFrame:
    """Add ``name``: 1..n in the order of ``order_by``, nulls first.

    The rows are range-partitioned and sorted on all of ``order_by``, then staged with their
    place in their partition; a table of one row per partition turns places into keys. A key
    prefix shared by very many rows is cut by the later columns.

    ``spread_copies`` also cuts groups of rows equal in every column, by their place in the
    input. Retried tasks must then see their rows in the same order, so ``df`` has to be a
    scan of stored files followed by nothing but filters, projections and broadcast joins.

    ``rows``, where known, sizes the sort of a large table: a task for every
    ``rows_per_partition``, and never fewer than ``spark.sql.shuffle.partitions``.
    """
    columns = df.columns
    order = [F.col(c).asc_nulls_first() for c in order_by]
    split = list(order)
    if spread_copies:
        df = df.withColumn(_COPY, F.monotonically_increasing_id())
        split.append(F.col(_COPY).asc())
    placed = stage(
        df.repartitionByRange(*_sort_partitions(df, rows, rows_per_partition), *split)
        .sortWithinPartitions(*order)
        .select(*columns, F.monotonically_increasing_id().alias(_SLOT)),
        name,
    )

    place = F.col(_SLOT).bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    partition = F.shiftright(_SLOT, _PARTITION_BIT)
    earlier = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the staging write.
    offsets = (
        placed.groupBy(partition.alias("_partition"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_partition", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
        )
    )
    key = (F.col("_offset") + place + 1).cast(key_type).alias(name)
    return placed.join(F.broadcast(offsets), partition == F.col("_partition")).select(
        *columns, key
    )


def continue_dense_key(
    rows: DataFrame,
    known: DataFrame,
    business: str,
    name: str,
    key_type: str = "int",
) -> DataFrame:
    """A dimension that goes on from ``known``: ``rows``, one per ``business`` key, with ``name``.

    Business keys that ``known`` has keep their key, new ones are numbered behind its highest in
    the order of ``business``, and rows of ``known`` that ``rows`` no longer has stay as they
    were, so no key ever changes its meaning or is given twice. Without known rows this is
    ``assign_dense_key``. A business key or a key that ``known`` has twice is an error.
    """
    columns = [c for c in rows.columns if c != name]
    rows = stage(rows.select(columns), f"{name}-rows")
    old = known.select(F.col(business).alias("_business"), F.col(name).alias("_key"))
    twice = F.concat(F.lit("more than one row for "), F.coalesce(F.col("_business"), F.lit("null")))
    keys = old.groupBy("_business").agg(
        F.when(F.count(F.lit(1)) > 1, F.raise_error(twice)).otherwise(F.max("_key")).alias("_key")
    )
    highest, given, distinct = known.agg(
        F.max(name), F.count(F.lit(1)), F.count_distinct(name)
    ).first()
    if given != distinct:
        raise ValueError(f"{name} is null or repeated in the known rows")
    matched = rows.join(keys, F.col(business).eqNullSafe(F.col("_business")), "left")
    kept = matched.filter("_key IS NOT NULL").select(*columns, F.col("_key").alias(name))
    new = assign_dense_key(
        matched.filter("_key IS NULL").select(columns), [business], name, key_type
    ).withColumn(name, (F.col(name) + (highest or 0)).cast(key_type))
    current = rows.select(F.col(business).alias("_business"))
    gone = known.join(current, F.col(business).eqNullSafe(F.col("_business")), "left_anti")
    return kept.unionByName(new).unionByName(gone.select(*columns, name))
