from __future__ import annotations

import os
import time

import pytest
from rows import raw_line, raw_orders

from tillbook.operators.events import parse_events, to_event_json
from tillbook.streaming import replay


def lines(spark, n=23):
    rows = [raw_line(invoice=str(1000 + (i * 7) % n), code="A", quantity=i % 5) for i in range(n)]
    return raw_orders(spark, *rows, rows[3])


def sent_rows(spark, folder):
    """Lines in the order they were sent."""
    out = []
    for batch in sorted(os.listdir(folder), key=lambda name: int(name[6:])):
        for name in sorted(os.listdir(os.path.join(folder, batch))):
            if name.endswith(".txt"):
                with open(os.path.join(folder, batch, name)) as file:
                    out += [(int(batch[6:]), line.rstrip("\n")) for line in file]
    return out


def expected(spark, numbered):
    rows = to_event_json(numbered.orderBy(replay.NUMBER).coalesce(1)).collect()
    return [row["value"] for row in rows]


def test_lines_are_numbered_in_order(spark):
    numbered = replay.number_lines(lines(spark)).orderBy(replay.NUMBER).collect()
    assert [row[replay.NUMBER] for row in numbered] == list(range(1, 25))
    invoices = [row["Invoice"] for row in numbered]
    assert invoices == sorted(invoices)


def test_each_line_is_sent_once_in_order_at_a_pace(spark, tmp_path):
    numbered = replay.number_lines(lines(spark))
    folder = str(tmp_path / "messages")
    times = []
    send = replay.to_folder(folder)

    def timed(messages, batch_id):
        times.append(time.monotonic())
        send(messages, batch_id)

    n = replay.run_paced_replay(numbered, timed, str(tmp_path / "checkpoint"), 5)
    assert n == 24
    found = sent_rows(spark, folder)
    assert [text for _, text in found] == expected(spark, numbered)
    assert [batch for batch, _ in found] == [i // 5 for i in range(24)]
    # Five batches on a beat of a second: the last at least three whole ones after the first.
    assert len(times) == 5 and times[-1] - times[0] > 3
    read_back = parse_events(spark.read.text(folder))
    assert read_back.filter("invoice_no IS NULL").count() == 0


def test_a_replay_goes_on_where_it_was(spark, tmp_path):
    numbered = replay.number_lines(lines(spark))
    folder, checkpoint = str(tmp_path / "messages"), str(tmp_path / "checkpoint")
    send = replay.to_folder(folder)
    started = []

    def failing(messages, batch_id):
        started.append(batch_id)
        if batch_id == 2:
            # Part of the batch is out when the sender fails.
            send(messages.limit(2), batch_id)
            raise OSError("cable cut")
        send(messages, batch_id)

    with pytest.raises(Exception, match="cable cut"):
        replay.run_paced_replay(numbered, failing, checkpoint, 50, 0.1)
    assert started == [0, 1, 2]
    again = []

    def noted(messages, batch_id):
        again.append(batch_id)
        send(messages, batch_id)

    replay.run_paced_replay(numbered, noted, checkpoint, 50, 0.1)
    assert again == [2, 3, 4]
    assert [text for _, text in sent_rows(spark, folder)] == expected(spark, numbered)


def test_nothing_to_send(spark, tmp_path):
    numbered = replay.number_lines(lines(spark).limit(0))
    sent = []
    assert replay.run_paced_replay(numbered, lambda *_: sent.append(1), str(tmp_path), 5, 0.1) == 0
    assert sent == []


def test_one_large_batch_has_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "LINES_PER_TASK", 4)
    numbered = replay.number_lines(lines(spark))
    folder = str(tmp_path / "messages")
    replay.run_paced_replay(numbered, replay.to_folder(folder), str(tmp_path / "checkpoint"), 24, 1)
    assert [text for _, text in sent_rows(spark, folder)] == expected(spark, numbered)
    names = [name for name in os.listdir(f"{folder}/batch=0") if name.endswith(".txt")]
    assert len(names) > 3


def test_a_topic_gets_a_large_batch_piece_by_piece(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "LINES_PER_TASK", 10)
    numbered = replay.number_lines(lines(spark))
    sent = []

    def write(messages, *_):
        assert messages.rdd.getNumPartitions() == 1
        sent.append([row["value"] for row in messages.collect()])

    monkeypatch.setattr(replay, "write_events_to_kafka", write)
    send = replay.to_topic("host:9092", "orders")
    replay.run_paced_replay(numbered, send, str(tmp_path / "checkpoint"), 24, 1)
    assert [len(piece) for piece in sent] == [10, 10, 4]
    assert [text for piece in sent for text in piece] == expected(spark, numbered)
