"""Stored events, window metrics and their pieces, all by date and micro-batch.

A batch writes only to its own ``date=/batch_id=`` folders, replacing what an earlier attempt
of the same batch left there, so a retry changes nothing. Folders and checkpoint belong
together, see ``identity``; closed days are merged into few files, see ``generations``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import pairwise

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.operators.metrics import (
    KEYS,
    in_windows,
    merge_pieces,
    pieces_metrics,
    window_metrics,
    window_pieces,
)
from tillbook.schemas import (
    METRIC_PIECES,
    METRIC_WINDOW_SECONDS,
    STORED_EVENT,
    STORED_METRICS,
    WINDOW_METRICS,
)
from tillbook.sinks.lake import write_partitions
from tillbook.streaming.generations import UNDATED, merge_days, merged_rows, read_table

ROWS_PER_FILE = 500_000
# Bounds of more spans make generated code too long to be compiled.
MOST_SPANS = 8


def batch_days(batch: DataFrame) -> list[Row]:
    """``date, rows, first, last`` per day, in epoch seconds.

    One row for each calendar day in the batch; events without a time have a day of their
    own, null.
    """
    moment = F.col("invoice_date")
    return (
        batch.groupBy(F.to_date(moment).cast("string").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.unix_seconds(F.min(moment)).alias("first"),
            F.unix_seconds(F.max(moment)).alias("last"),
        )
        .collect()
    )


def _day_tasks(batch: DataFrame, days: list[Row]) -> int:
    """How many tasks write the days of a batch, each of which has a file of its own."""
    return max(1, min(len(days), batch.sparkSession.sparkContext.defaultParallelism))


def append_events(
    batch: DataFrame, batch_id: int, store: str, days: list[Row] | None = None
) -> None:
    """Write enriched events to ``store``, partitioned by the date of ``invoice_date``.

    Range partitioning by time gives each file few dates and a narrow time span, which the
    metric refresh prunes by; the place in the batch cuts even a single busy second.
    """
    if days is None:
        days = batch_days(batch)
    days = _unmerged(batch.sparkSession, store, batch_id, days)
    if not days:
        return
    rows = sum(day["rows"] for day in days)
    tasks = max(-(-rows // ROWS_PER_FILE), _day_tasks(batch, days))
    ranged = (
        _of_days(batch, days)
        .withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(tasks, "invoice_date", "_place")
        .drop("_place")
    )
    dated = ranged.withColumns(
        {"date": F.to_date("invoice_date"), "batch_id": F.lit(batch_id).cast("long")}
    )
    write_partitions(dated, store, "date", "batch_id")


def _unmerged(spark: SparkSession, store: str, batch_id: int, days: list[Row]) -> list[Row]:
    """The days of a batch that no generation holds it in already.

    Spark doesn't run a committed batch again, and only those are merged. So a batch that is
    merged comes again only after its checkpoint was put back; it must then be the same.
    """
    held = merged_rows(spark, store, STORED_EVENT, [d["date"] or UNDATED for d in days], batch_id)
    for day in days:
        rows = held.get(day["date"] or UNDATED, day["rows"])
        if rows != day["rows"]:
            raise ValueError(
                f"batch {batch_id} has {day['rows']} events of {day['date']}, and {rows} where "
                f"{store} has merged it: the checkpoint has been put back"
            )
    return [day for day in days if (day["date"] or UNDATED) not in held]


def _of_days(batch: DataFrame, days: list[Row]) -> DataFrame:
    """The events of a batch on the given days of it."""
    day = F.to_date("invoice_date").cast("string")
    dated = [d["date"] for d in days if d["date"] is not None]
    undated = day.isNull() if len(dated) < len(days) else F.lit(False)
    return batch.filter(day.isin(dated) | undated)


def read_events(spark: SparkSession, store: str) -> DataFrame:
    """All stored events."""
    return read_table(spark, store, STORED_EVENT)


def _spans(days: list[Row]) -> list[tuple[int, int]]:
    """From the first window of each day to its last, in epoch seconds, ``MOST_SPANS`` at most.

    Spans that meet are one; of more, those with the smallest gaps between them are put together.
    """
    size = METRIC_WINDOW_SECONDS
    spans = sorted(
        (day["first"] // size * size, (day["last"] // size + 1) * size) for day in days
    )
    gaps = sorted(((b[0] - a[1], i) for i, (a, b) in enumerate(pairwise(spans), 1)), reverse=True)
    cuts = sorted(i for gap, i in gaps[: MOST_SPANS - 1] if gap > 0)
    return [
        (spans[i][0], spans[j - 1][1]) for i, j in pairwise([0, *cuts, len(spans)])
    ]


def _read_days(
    spark: SparkSession, table: str, schema: T.StructType, moment: str, days: list[Row]
) -> DataFrame:
    """Rows of the given days, on each at least from the first window of the batch to its last."""
    rows = read_table(spark, table, schema, [day["date"] for day in days])

    def touched(span: tuple[int, int]) -> Column:
        """Files hold narrow time spans, so these bounds skip most of a day that grows."""
        since, until = (F.timestamp_seconds(F.lit(second)) for second in span)
        return (F.col(moment) >= since) & (F.col(moment) < until)

    return rows.filter(reduce(Column.__or__, map(touched, _spans(days))))


@contextmanager
def _touched_windows(batch: DataFrame) -> Iterator[DataFrame]:
    """The windows that a batch has an event in, worked out once: 288 at most for each of its days.

    Kept, because otherwise a join with them would also put its other side's bounds to every event,
    and for each table of a union again.
    """
    windows = in_windows(batch).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield F.broadcast(windows)
    finally:
        windows.unpersist()


def _write_metrics(windows: DataFrame, batch_id: int, metrics: str, tasks: int) -> None:
    dated = windows.withColumns(
        {"date": F.to_date("window_start"), "batch_id": F.lit(batch_id).cast("long")}
    )
    # A day has at most 288 windows, so however the days fall to tasks, these are small.
    write_partitions(dated.repartition(tasks, "date"), metrics, "date", "batch_id")


def refresh_metrics(
    batch: DataFrame, batch_id: int, store: str, metrics: str, days: list[Row] | None = None
) -> None:
    """Recompute, from the stored events, each window that the batch has an event in.

    Distinct counts of two batches cannot be added, so a window is always computed whole.
    Only the touched days are listed and only their touched time spans are read.
    """
    if days is None:
        days = batch_days(batch)
    dated_days = [day for day in days if day["date"] is not None]
    if not dated_days:
        return
    lines = _read_days(batch.sparkSession, store, STORED_EVENT, "invoice_date", dated_days)
    columns = [f.name for f in STORED_EVENT if f.name not in ("date", "batch_id")]
    with _touched_windows(batch) as touched:
        in_touched = in_windows(lines, *columns).join(touched, "window_start", "left_semi")
        windows = window_metrics(in_touched.select(columns))
        _write_metrics(windows, batch_id, metrics, _day_tasks(batch, dated_days))


def append_pieces(
    batch: DataFrame, batch_id: int, pieces: str, days: list[Row] | None = None
) -> None:
    """Write what a batch adds to the metrics of its windows, by date.

    Distinct names of a window instead of events: a batch has at most three pieces for a line,
    and far fewer where invoices and products repeat.
    """
    if days is None:
        days = batch_days(batch)
    dated_days = [day for day in days if day["date"] is not None]
    if not dated_days:
        return
    rows = sum(day["rows"] for day in dated_days)
    tasks = max(-(-rows // ROWS_PER_FILE), _day_tasks(batch, dated_days))
    dated = window_pieces(batch).withColumns(
        {"date": F.to_date("window_start"), "batch_id": F.lit(batch_id).cast("long")}
    )
    names = ("piece", "invoice_no", "stock_code", "country")
    ranged = dated.repartitionByRange(tasks, "window_start", *names)
    write_partitions(ranged.select(METRIC_PIECES.names), pieces, "date", "batch_id")


def refresh_from_pieces(
    batch: DataFrame, batch_id: int, pieces: str, metrics: str, days: list[Row] | None = None
) -> None:
    """Like ``refresh_metrics``, from the stored pieces of the touched windows.

    Pieces of several batches are put together, so what is read grows with the distinct names
    of the windows and the batches that touched them, and not with their events.
    """
    if days is None:
        days = batch_days(batch)
    dated_days = [day for day in days if day["date"] is not None]
    if not dated_days:
        return
    stored = _read_days(batch.sparkSession, pieces, METRIC_PIECES, "window_start", dated_days)
    with _touched_windows(batch) as touched:
        in_touched = stored.join(touched, "window_start", "left_semi")
        windows = pieces_metrics(merge_pieces(in_touched), stored=True)
        _write_metrics(windows, batch_id, metrics, _day_tasks(batch, dated_days))


def backfill_pieces(spark: SparkSession, store: str, pieces: str, committed: int) -> None:
    """Pieces of all stored events up to batch ``committed``, for a stream that had none yet.

    The stream must stand still, and go on with ``pieces`` after ``adopt_run``.
    """
    events = read_table(spark, store, STORED_EVENT).filter(F.col("batch_id") <= committed)
    dated = window_pieces(events).withColumns(
        {"date": F.to_date("window_start"), "batch_id": F.lit(committed).cast("long")}
    )
    names = ("window_start", "piece", "invoice_no", "stock_code", "country")
    ranged = dated.repartitionByRange(*names)
    write_partitions(ranged.select(METRIC_PIECES.names), pieces, "date", "batch_id")


def read_piece_metrics(spark: SparkSession, pieces: str) -> DataFrame:
    """The metrics of every window, put together from the pieces of all batches."""
    merged = merge_pieces(read_table(spark, pieces, METRIC_PIECES))
    return pieces_metrics(merged, stored=True)


def latest_metrics(stored: DataFrame) -> DataFrame:
    """One row per window: that of the last batch that touched it."""
    values = [f.name for f in WINDOW_METRICS if f.name not in KEYS]
    return (
        stored.groupBy(KEYS)
        .agg(F.max_by(F.struct(*values), "batch_id").alias("latest"))
        .select(*KEYS, "latest.*")
    )


def changed_metrics(stored: DataFrame, since: int) -> DataFrame:
    """The current metrics of the windows that a batch after ``since`` has touched."""
    newer = stored.filter(F.col("batch_id") > since)
    return latest_metrics(newer)


def read_metrics(spark: SparkSession, metrics: str) -> DataFrame:
    """The current metrics of every window."""
    return latest_metrics(read_table(spark, metrics, STORED_METRICS))


def _newest_metrics(stored: DataFrame) -> DataFrame:
    """Stored metrics, only the last row of each window, with the batch that it is from."""
    values = [f.name for f in STORED_METRICS if f.name not in KEYS]
    newest = F.max_by(F.struct(*values), "batch_id").alias("newest")
    return stored.groupBy(KEYS).agg(newest).select(*KEYS, "newest.*")


def _merged_pieces(stored: DataFrame) -> DataFrame:
    """Stored pieces put together, under the last batch of their window."""
    last = stored.groupBy("window_start").agg(F.max("batch_id").alias("batch_id"))
    merged = merge_pieces(stored).withColumn("date", F.to_date("window_start"))
    return merged.join(last, "window_start")


def merge_closed_days(
    spark: SparkSession,
    committed: int,
    before: str,
    store: str,
    metrics: str | None = None,
    pieces: str | None = None,
) -> dict[str, list[str]]:
    """Merge the days before ``before`` of all tables of a stream; the days merged by table.

    ``committed`` is the stream's last finished batch, see ``committed_batch``; the stream may
    go on meanwhile. Late events of a merged day are read beside its generation, and merged with
    it the next time.
    """
    done = {store: merge_days(spark, store, STORED_EVENT, committed, before, "invoice_date")}
    if metrics is not None:
        done[metrics] = merge_days(
            spark, metrics, STORED_METRICS, committed, before, "window_start", _newest_metrics
        )
    if pieces is not None:
        done[pieces] = merge_days(
            spark, pieces, METRIC_PIECES, committed, before, "window_start", _merged_pieces
        )
    return done
