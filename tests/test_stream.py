from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from rows import event, events

from tillbook.operators.events import enrich_events, parse_events
from tillbook.operators.metrics import streaming_window_metrics, window_metrics
from tillbook.sources.fixtures import EVENT_RATE, order_events, order_messages
from tillbook.streaming import orders, store
from tillbook.streaming.orders import run_order_stream, store_batch
from tillbook.streaming.source import kafka_source_options, read_folder


@pytest.fixture
def folders(tmp_path):
    return {
        name: str(tmp_path / name) for name in ("messages", "store", "metrics", "checkpoint")
    }


def write_file(folder, number, messages):
    """One message file; the stream takes files by modification time."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{number}.txt")
    with open(path, "w") as file:
        file.writelines(message + "\n" for message in messages)
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def messages_of(spark, *rows):
    return [row["value"] for row in order_messages(events(spark, *rows)).collect()]


def run(spark, folders, rate=EVENT_RATE, max_files=1):
    query = run_order_stream(
        read_folder(spark, folders["messages"], max_files),
        folders["store"],
        folders["metrics"],
        folders["checkpoint"],
        rate,
        available_now=True,
    )
    query.awaitTermination()


def assert_same(left, right):
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def assert_stored(spark, folders, expected):
    stored = store.read_events(spark, folders["store"])
    assert_same(stored.drop("date", "batch_id"), expected)
    assert stored.filter("NOT date <=> to_date(invoice_date)").count() == 0
    assert_same(store.read_metrics(spark, folders["metrics"]), window_metrics(expected))


def test_stream_equals_batch_when_windows_span_batches(spark, sf_dir, folders):
    source = order_events(spark, sf_dir)
    numbered = order_messages(source).select("value").collect()
    for part in range(3):
        write_file(folders["messages"], part, [row["value"] for row in numbered[part::3]])
    run(spark, folders)
    assert_stored(spark, folders, enrich_events(source, EVENT_RATE))
    assert os.path.isdir(os.path.join(folders["store"], "date=2024-01-01", "batch_id=2"))


def test_late_and_unreadable_messages(spark, folders):
    first = [event(), event(invoice="2", when="2024-01-03T10:00:00")]
    late = [
        event(invoice="3", when="2024-01-01T00:04:59", country="EIRE"),
        event(invoice="4", when="bad"),
    ]
    write_file(folders["messages"], 1, messages_of(spark, *first))
    run(spark, folders)
    write_file(folders["messages"], 2, [*messages_of(spark, *late), "not json"])
    run(spark, folders)
    nothing = (None,) * 8
    expected = enrich_events(events(spark, *first, *late, nothing), EVENT_RATE)
    assert_stored(spark, folders, expected)
    early = store.read_metrics(spark, folders["metrics"]).orderBy("window_start").first()
    assert (early["order_count"], early["top_country"]) == (2, "EIRE")


def test_replayed_batch_changes_nothing(spark, folders):
    batches = [
        enrich_events(events(spark, event(invoice=str(i)), event(invoice="9")), EVENT_RATE)
        for i in range(2)
    ]
    for batch_id in (0, 1, 1):
        store_batch(batches[batch_id], batch_id, folders["store"], folders["metrics"])
    assert_stored(spark, folders, batches[0].unionByName(batches[1]))


def test_batch_without_times_has_no_metrics(spark, folders):
    batch = enrich_events(events(spark, event(when=None)), EVENT_RATE)
    store_batch(batch, 0, folders["store"], folders["metrics"])
    assert store.read_events(spark, folders["store"]).count() == 1
    assert not os.path.exists(folders["metrics"])
    store_batch(batch.limit(0), 1, folders["store"], folders["metrics"])
    assert store.read_events(spark, folders["store"]).count() == 1


def test_batches_of_many_days(spark, folders):
    days = [dt.datetime(2024, 1, day, hour) for day in range(1, 15) for hour in (0, 12)]
    batches = [
        enrich_events(
            events(spark, *(event(invoice=f"{b}-{d}", when=d.isoformat()) for d in days[b:])),
            EVENT_RATE,
        )
        for b in range(3)
    ]
    for batch_id, batch in enumerate(batches):
        store_batch(batch, batch_id, folders["store"], folders["metrics"])
    assert_stored(spark, folders, batches[0].union(batches[1]).union(batches[2]))


def test_a_busy_second_is_cut_into_files(spark, folders, monkeypatch):
    monkeypatch.setattr(store, "ROWS_PER_FILE", 1000)
    batch = enrich_events(events(spark, *[event()] * 4000), EVENT_RATE).repartition(4)
    store.append_events(batch, 0, folders["store"])
    folder = os.path.join(folders["store"], "date=2024-01-01", "batch_id=0")
    assert len([name for name in os.listdir(folder) if name.endswith(".parquet")]) == 4
    assert store.read_events(spark, folders["store"]).count() == 4000


def test_changed_windows(spark, folders):
    for batch_id, hour in enumerate((0, 5, 0)):
        when = f"2024-01-01T0{hour}:00:00"
        batch = enrich_events(events(spark, event(invoice=str(batch_id), when=when)), EVENT_RATE)
        store_batch(batch, batch_id, folders["store"], folders["metrics"])
    stored = spark.read.parquet(folders["metrics"])
    found = {
        since: {r.window_start.hour: r.order_count for r in store.changed_metrics(stored, since).collect()}
        for since in (-1, 0, 1, 2)
    }
    assert found == {-1: {0: 2, 5: 1}, 0: {0: 2, 5: 1}, 1: {0: 2}, 2: {}}


def test_untouched_windows_are_not_written_again(spark, folders):
    first, second = "2024-01-01T00:00:00", "2024-01-01T12:00:00"
    for batch_id, when in enumerate([first, second]):
        batch = enrich_events(events(spark, event(when=when)), EVENT_RATE)
        store_batch(batch, batch_id, folders["store"], folders["metrics"])
    written = spark.read.parquet(folders["metrics"])
    assert written.filter("batch_id = 1").count() == 1


def test_a_new_checkpoint_is_refused_for_a_used_store(spark, folders):
    write_file(folders["messages"], 1, messages_of(spark, event()))
    run(spark, folders)
    run(spark, folders)
    stored = store.read_events(spark, folders["store"]).collect()
    other = folders | {"checkpoint": folders["checkpoint"] + "2"}
    with pytest.raises(ValueError, match="is new"):
        run(spark, other)
    assert store.read_events(spark, folders["store"]).collect() == stored


def test_an_amount_without_a_decimal_does_not_stop_the_stream(spark, folders):
    rows = [event(), event(invoice="2", price=1e300), event(when="2024-01-01T09:00:00")]
    for number, row in enumerate(rows):
        write_file(folders["messages"], number, messages_of(spark, row))
    run(spark, folders)
    assert store.read_events(spark, folders["store"]).count() == 3
    first, second = store.read_metrics(spark, folders["metrics"]).orderBy("window_start").collect()
    assert (first["order_count"], first["total_revenue_gbp"]) == (2, None)
    assert second["total_revenue_gbp"] is not None


def test_stored_events_are_not_shuffled_before_the_touched_windows(spark, folders, monkeypatch):
    """Whatever the size of the batch, the small side of the join is broadcast."""
    plans = []

    def capture(df, *_):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    batch = enrich_events(events(spark, event()), EVENT_RATE)
    large = batch.crossJoin(spark.range(2_000_000)).drop("id").persist()
    large.count()
    try:
        store.append_events(batch, 0, folders["store"])
        monkeypatch.setattr(store, "write_partitions", capture)
        store.refresh_metrics(large, 1, folders["store"], folders["metrics"])
    finally:
        large.unpersist()
    (plan,) = plans
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_errors_stop_the_stream_and_nothing_is_skipped(spark, folders, monkeypatch):
    write_file(folders["messages"], 1, messages_of(spark, event()))

    def fail(*_):
        raise OSError("disk on fire")

    with monkeypatch.context() as broken:
        broken.setattr(orders, "refresh_metrics", fail)
        with pytest.raises(Exception, match="disk on fire"):
            run(spark, folders)
    run(spark, folders)
    assert_stored(spark, folders, enrich_events(events(spark, event()), EVENT_RATE))


def test_watermarked_metrics(spark, folders):
    rows = [
        event(invoice="1", when="2024-01-01T00:01:00"),
        event(invoice="1", when="2024-01-01T00:02:00"),
        event(invoice="2", when="2024-01-01T00:03:00"),
        event(invoice="3", when="2024-01-01T00:07:00"),
        event(invoice="4", when="2024-01-01T06:00:00"),
    ]
    for number, row in enumerate(rows):
        write_file(folders["messages"], number, messages_of(spark, row))
    stream = enrich_events(parse_events(read_folder(spark, folders["messages"], 1)), EVENT_RATE)
    query = (
        streaming_window_metrics(stream)
        .writeStream.format("memory")
        .queryName("watermarked")
        .outputMode("append")
        .option("checkpointLocation", folders["checkpoint"])
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = spark.table("watermarked")
    expected = window_metrics(enrich_events(events(spark, *rows), EVENT_RATE))
    # The last window is open until the watermark passes it.
    closed = expected.filter(F.col("window_start") < "2024-01-01 06:00:00")
    assert_same(found, closed)


def test_watermarked_leaders_and_ties(spark, folders):
    first = [
        event("1", "B", quantity=3, country="EIRE"),
        event("1", "A", quantity=1, country="EIRE"),
        event("2", "A", quantity=2, when="2024-01-01T00:04:59"),
        event("3", None, quantity=9, country=None),
        event(None, "C", quantity=-1),
        event("4", "A", when="2024-01-01T00:05:00", price=1e300),
    ]
    late = [event("5", "Z", quantity=50, when="2024-01-01T00:03:00", country="USA")]
    last = [event("6", when="2024-01-01T06:00:00")]
    # The late line comes within the delay, in a later batch than its window's others.
    files = [first, [event("7", "A", when="2024-01-01T00:09:00")], late, last]
    for number, rows in enumerate(files):
        write_file(folders["messages"], number, messages_of(spark, *rows))
    stream = enrich_events(parse_events(read_folder(spark, folders["messages"], 1)), EVENT_RATE)
    query = (
        streaming_window_metrics(stream)
        .writeStream.format("memory")
        .queryName("watermarked_leaders")
        .outputMode("append")
        .option("checkpointLocation", folders["checkpoint"])
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = spark.table("watermarked_leaders")
    whole = window_metrics(enrich_events(events(spark, *sum(files, [])), EVENT_RATE))
    assert_same(found, whole.filter(F.col("window_start") < "2024-01-01 06:00:00"))
    leaders = found.orderBy("window_start").first()
    assert (leaders["top_product_code"], leaders["top_country"]) == ("Z", "EIRE")  # all countries have one invoice
    # Closed windows hold no state: only the last line's pieces are left.
    assert all(op.numRowsTotal <= 3 for op in query.lastProgress.stateOperators)


def test_kafka_options():
    assert kafka_source_options("host:9092", "orders.raw", max_offsets=200) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "orders.raw",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "200",
    }
    assert "maxOffsetsPerTrigger" not in kafka_source_options("h", "t", "earliest")
