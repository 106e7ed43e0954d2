"""Paced replay: numbered lines sent in order, so many a second.

Spark's rate source counts upwards by a fixed number a batch, and its place is in the checkpoint.
Every batch sends the lines with its numbers. So a replay that is started again goes on where it
was, and a batch that was cut off is sent again whole.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.operators.events import to_event_json
from tillbook.operators.keys import assign_dense_key
from tillbook.schemas import REPLAY_ROWS_PER_SECOND
from tillbook.sinks.topic import write_events_to_kafka
from tillbook.staging import stage

NUMBER = "_number"
ORDER = ("InvoiceDate", "Invoice", "StockCode")
# Lines that one task sorts and sends.
LINES_PER_TASK = 500_000

# With an attribute ``in_turn``, it gets a large batch in pieces, one after the other.
Send = Callable[[DataFrame, int], None]


def number_lines(raw: DataFrame, first: Sequence[str] = ORDER) -> DataFrame:
    """Raw lines, staged, with their place 1..n by time, invoice and stock code, then all columns.

    The stored files hold narrow ranges of numbers, so a batch reads little more than its lines.
    """
    order = [*first, *(c for c in raw.columns if c not in first)]
    stored = stage(raw, "replay")
    keyed = assign_dense_key(
        stored, order, NUMBER, "long", spread_copies=True, rows=stored.count()
    )
    return stage(keyed, "numbered")


def to_folder(path: str) -> Send:
    """Messages of a batch as text files of its own, in order by name; sending it again replaces them."""

    def send(messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return send


def to_topic(servers: str, topic: str) -> Send:
    """Messages to a Kafka topic; a batch that was cut off is sent again, so at least once."""

    def send(messages: DataFrame, _: int) -> None:
        write_events_to_kafka(messages, servers, topic)

    send.in_turn = True
    return send


def _in_order(lines: DataFrame, count: int) -> DataFrame:
    """Messages of ``count`` numbered lines, in order within a partition and from one to the next."""
    tasks = -(-count // LINES_PER_TASK)
    parts = lines.coalesce(1) if tasks <= 1 else lines.repartitionByRange(tasks, NUMBER)
    return to_event_json(parts.sortWithinPartitions(NUMBER))


def run_paced_replay(
    numbered: DataFrame,
    send: Send,
    checkpoint: str,
    rows_per_second: int = REPLAY_ROWS_PER_SECOND["full"],
    seconds: float = 1.0,
) -> int:
    """Send all lines of ``number_lines`` and return how many there are.

    ``seconds`` is the time between batches; each has ``rows_per_second * seconds`` lines. A task
    has ``LINES_PER_TASK`` of them at most, and their partitions are in order too; a ``send`` that
    is ``in_turn``, as for a topic, gets them one after the other. A batch that takes longer
    delays the next, so the pace is the fastest there can be. A replay keeps its pace and lines
    from start to start: the checkpoint counts batches of one size.
    """
    spark = numbered.sparkSession
    lines_a_batch = max(1, round(rows_per_second * seconds))
    last = numbered.count()
    done = threading.Event()

    def batch(numbers: DataFrame, batch_id: int) -> None:
        first, until = numbers.agg(F.min("value"), F.max("value")).first()
        if first is None:
            return
        if first >= last:
            # All batches with lines are committed by now.
            done.set()
            return
        until = min(until + 1, last)
        piece = LINES_PER_TASK if getattr(send, "in_turn", False) else until - first
        for start in range(first + 1, until + 1, piece):
            end = min(start + piece - 1, until)
            due = numbered.filter(F.col(NUMBER).between(start, end))
            send(_in_order(due, end - start + 1), batch_id)

    query = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", lines_a_batch)
        .option("numPartitions", 1)
        .load()
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{round(seconds * 1000)} milliseconds")
        .start()
    )
    try:
        while not done.wait(0.1):
            if not query.isActive:
                query.awaitTermination()  # raises what stopped it
                break
    finally:
        query.stop()
    return last
