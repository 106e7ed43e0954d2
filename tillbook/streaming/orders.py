"""The order stream job."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillbook.operators.events import MESSAGE, REASON, enrich_events, parse_events, sort_out_events
from tillbook.schemas import STREAM_FALLBACK_RATE
from tillbook.streaming.identity import claim_run
from tillbook.streaming.quarantine import put_aside, readable
from tillbook.streaming.store import (
    append_events,
    append_pieces,
    batch_days,
    refresh_from_pieces,
    refresh_metrics,
)


def store_batch(
    batch: DataFrame,
    batch_id: int,
    store: str,
    metrics: str,
    pieces: str | None = None,
    quarantine: str | None = None,
) -> None:
    """All sinks of one micro-batch. Errors stop the stream, so no batch is skipped."""
    if REASON in batch.columns:
        # Texts of readable messages are not kept.
        unread = F.when(F.col(REASON).isNotNull(), F.col(MESSAGE))
        batch = batch.withColumn(MESSAGE, unread)
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        events = batch
        if REASON in batch.columns:
            if quarantine is not None:
                put_aside(batch, batch_id, quarantine)
            events = readable(batch)
        days = batch_days(events)
        append_events(events, batch_id, store, days)
        if pieces is None:
            refresh_metrics(events, batch_id, store, metrics, days)
        else:
            append_pieces(events, batch_id, pieces, days)
            refresh_from_pieces(events, batch_id, pieces, metrics, days)
    finally:
        batch.unpersist()


def run_order_stream(
    messages: DataFrame,
    store: str,
    metrics: str,
    checkpoint: str,
    rate: float = STREAM_FALLBACK_RATE,
    available_now: bool = False,
    fractional: bool = False,
    interval: str | None = None,
    pieces: str | None = None,
    quarantine: str | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Start the stream: parse and enrich messages, store them, keep window metrics exact.

    ``available_now`` works off what has arrived and stops; otherwise it runs until stopped,
    with a batch every ``interval`` (such as "1 minute"), or as soon as the last one is done.
    Each batch writes files of its own, so a longer interval makes fewer and larger ones.

    With a folder for ``pieces``, metrics are put together from each batch's pieces instead of
    being computed again from the stored events. With one for ``quarantine``, messages that
    cannot be read go there, and not into the store as events without any value; ``strict`` also
    sends those there of which only a field cannot be read.
    """
    folders = [folder for folder in (store, metrics, pieces, quarantine) if folder is not None]
    claim_run(messages.sparkSession, checkpoint, folders)
    parsed = parse_events(messages) if quarantine is None else sort_out_events(messages, strict)
    enriched = enrich_events(parsed, rate, fractional)
    writer = enriched.writeStream.foreachBatch(
        lambda batch, batch_id: store_batch(batch, batch_id, store, metrics, pieces, quarantine)
    ).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()
