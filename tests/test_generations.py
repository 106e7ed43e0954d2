"""Merged days, and metrics put together from pieces."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from rows import event, events
from test_metrics import random_events
from test_stream import assert_same, folders, messages_of, write_file  # noqa: F401

from tillbook.operators.events import enrich_events
from tillbook.operators.metrics import merge_pieces, pieces_metrics, window_metrics, window_pieces
from tillbook.schemas import METRIC_PIECES, STORED_EVENT
from tillbook.sources.fixtures import EVENT_RATE
from tillbook.streaming import generations, store
from tillbook.streaming.orders import store_batch

LATER = "2024-02-01"


def batches_of(spark, n=4, seed=1, size=60):
    """Batches with events of the same three days and windows, late ones and some without a time."""
    r = random.Random(seed)
    days = [dt.datetime(2024, 1, day, 10) for day in (1, 2, 3)]
    out = []
    for b in range(n):
        rows = []
        for _ in range(size):
            when = r.choice(days) + dt.timedelta(minutes=r.randrange(20))
            rows.append(
                event(
                    invoice=str(r.randrange(12)), code=r.choice("ABC"), quantity=r.choice([-1, 1, 2]),
                    when=r.choice([None, *[when.isoformat()] * 9]), country=r.choice(["EIRE", "France"]),
                )
            )
        out.append(enrich_events(events(spark, *rows), EVENT_RATE))
    return out


@pytest.fixture
def tables(folders, tmp_path):  # noqa: F811
    return (folders["store"], folders["metrics"], str(tmp_path / "pieces"))


def put(batches, ids, tables):
    for batch_id in ids:
        store_batch(batches[batch_id], batch_id, *tables)


def union(batches):
    whole = batches[0]
    for batch in batches[1:]:
        whole = whole.unionByName(batch)
    return whole


def check(spark, tables, batches):
    expected = union(batches)
    stored = store.read_events(spark, tables[0])
    assert_same(stored.drop("date", "batch_id"), expected)
    assert stored.filter("NOT date <=> to_date(invoice_date)").count() == 0
    assert_same(store.read_metrics(spark, tables[1]), window_metrics(expected))
    assert_same(store.read_piece_metrics(spark, tables[2]), window_metrics(expected))


def test_pieces_of_parts_make_the_metrics_of_the_whole(spark):
    rows = list(random_events(400, 3)) + [event(price=1e300), event(invoice="x", price=4e27)]
    lines = [enrich_events(events(spark, *rows[i::3]), EVENT_RATE) for i in range(3)]
    pieces = union([window_pieces(part) for part in lines])
    whole = window_metrics(union(lines))
    assert_same(pieces_metrics(merge_pieces(pieces)), whole)
    # Putting parts together first changes nothing.
    early = merge_pieces(union([window_pieces(lines[0]), window_pieces(lines[1])]))
    assert_same(pieces_metrics(merge_pieces(early.unionByName(window_pieces(lines[2])))), whole)


def test_stored_pieces_make_the_same_metrics(spark):
    batches = batches_of(spark, 3)
    pieces = [window_pieces(b) for b in batches]
    merged = merge_pieces(union(pieces))
    assert_same(pieces_metrics(merged, stored=True), window_metrics(union(batches)))


def test_windows_of_several_batches_and_a_retry(spark, tables):
    batches = batches_of(spark, 3)
    put(batches, (0, 1, 1, 2, 2), tables)
    check(spark, tables, batches)


def test_a_refresh_reads_pieces_and_not_events(spark, tables, monkeypatch):
    read = []
    whole = store.read_table

    def noted(spark, table, *more):
        read.append(table)
        return whole(spark, table, *more)

    monkeypatch.setattr(store, "read_table", noted)
    batches = batches_of(spark, 2)
    put(batches, (0, 1), tables)
    assert set(read) == {tables[2]}
    # Many lines of one invoice and product are three pieces.
    many = enrich_events(events(spark, *[event(invoice="1", when="2024-01-09T00:00:00")] * 500), EVENT_RATE)
    put([many], (0,), (tables[0] + "2", tables[1] + "2", tables[2] + "2"))
    assert spark.read.parquet(tables[2] + "2").count() == 3


def test_merging_changes_no_result(spark, tables):
    batches = batches_of(spark, 4)
    put(batches, (0, 1), tables)
    done = store.merge_closed_days(spark, 1, "2024-01-03", *tables)
    days = ["2024-01-01", "2024-01-02"]
    assert done[tables[0]] == [*days, generations.UNDATED]
    assert done[tables[1]] == done[tables[2]] == days
    check(spark, tables, batches[:2])
    # Late events of merged days, then a second merge of all days.
    put(batches, (2, 3), tables)
    check(spark, tables, batches)
    store.merge_closed_days(spark, 3, LATER, *tables)
    check(spark, tables, batches)
    for table in tables:
        assert generations.drop_merged(spark, table, 0)
        assert not [n for n in generations.days_of(spark, table) if generations._live_batches(spark, table, n)]
    check(spark, tables, batches)


def test_merging_twice_changes_nothing(spark, tables):
    batches = batches_of(spark, 2)
    put(batches, (0, 1), tables)
    store.merge_closed_days(spark, 1, LATER, *tables)
    before = {table: generations.read_manifest(spark, table) for table in tables}
    done = store.merge_closed_days(spark, 1, LATER, *tables)
    assert done == {table: [] for table in tables}
    assert {table: generations.read_manifest(spark, table) for table in tables} == before


def test_one_file_for_a_day_of_many_batches(spark, tables):
    batches = batches_of(spark, 4, size=20)
    put(batches, range(4), tables)
    store.merge_closed_days(spark, 3, LATER, *tables)
    _, manifest = generations.read_manifest(spark, tables[0])
    (generation,) = {merged.generation for merged in manifest.values()}
    folder = os.path.join(tables[0], "_generations", generation, "day=2024-01-01")
    assert len([n for n in os.listdir(folder) if n.endswith(".parquet")]) == 1


def test_days_of_few_rows_are_merged_by_a_task_each(spark, tables):
    put(batches_of(spark, 2), (0, 1), tables)
    store.merge_closed_days(spark, 1, LATER, *tables)
    for table in tables:
        _, manifest = generations.read_manifest(spark, table)
        (generation,) = {merged.generation for merged in manifest.values()}
        found = [
            name.split("-")[1]
            for day in manifest
            for name in os.listdir(os.path.join(table, "_generations", generation, f"day={day}"))
            if name.endswith(".parquet")
        ]
        # A file a day, by more than one task.
        assert len(found) == len(manifest) > 2 and len(set(found)) > 1


def test_spans_of_days_are_few(monkeypatch):
    days = [{"first": 86_400 * n + 10, "last": 86_400 * (n + 1) - 10} for n in range(30)]
    assert store._spans(days) == [(0, 86_400 * 30)]
    assert store._spans(days[:3] + days[9:10]) == [(0, 86_400 * 3), (86_400 * 9, 86_400 * 10)]
    apart = [{"first": 86_400 * n + 700 * (n % 7), "last": 86_400 * n + 9_000} for n in range(30)]
    spans = store._spans(apart)
    assert len(spans) == store.MOST_SPANS
    for day in apart:
        assert [1 for since, until in spans if since <= day["first"] and day["last"] < until] == [1]
    assert len(store._spans(apart[:5])) == 5


def test_windows_of_a_batch_are_found_without_the_bounds_of_its_days(spark, tables, monkeypatch):
    batches = batches_of(spark, 2)
    plans = []
    write = store._write_metrics

    def seen(windows, *rest):
        plans.append(windows._jdf.queryExecution().optimizedPlan().toString())
        write(windows, *rest)

    monkeypatch.setattr(store, "_write_metrics", seen)
    put(batches, (0, 1), tables)
    check(spark, tables, batches)
    for plan in plans:
        # The events are read for the windows below what is kept of them.
        assert "Join LeftSemi" in plan and "InMemoryRelation [window_start" in plan


def test_batches_that_are_not_committed_are_left_alone(spark, tables):
    batches = batches_of(spark, 3)
    put(batches, (0, 1, 2), tables)
    store.merge_closed_days(spark, 1, LATER, *tables)
    _, manifest = generations.read_manifest(spark, tables[0])
    assert {merged.through for merged in manifest.values()} == {1}
    check(spark, tables, batches)
    # The last batch is run again, as Spark does when it has no commit.
    put(batches, (2,), tables)
    check(spark, tables, batches)


def test_a_merged_batch_that_comes_again(spark, tables):
    batches = batches_of(spark, 2)
    put(batches, (0, 1), tables)
    store.merge_closed_days(spark, 1, LATER, *tables)
    for table in tables:
        generations.drop_merged(spark, table, 0)
    put(batches, (1,), tables)
    check(spark, tables, batches)
    with pytest.raises(ValueError, match="put back"):
        put([batches[0], batches[1].limit(7)], (1,), tables)
    check(spark, tables, batches)


@pytest.mark.parametrize("step", ["write", "manifest", "drop"])
def test_a_crash_anywhere(spark, tables, monkeypatch, step):
    batches = batches_of(spark, 3)
    put(batches, (0, 1), tables)
    store.merge_closed_days(spark, 0, LATER, *tables)
    merge = generations.merge_days

    def crash(*_):
        raise OSError("power cut")

    with monkeypatch.context() as broken:
        if step == "write":
            # Files are there, and the manifest is not.
            broken.setattr(generations, "write_once", crash)
        elif step == "manifest":
            # The draft is there, under another name.
            broken.setattr(generations, "write_once", lambda s, path, text: crash())
        else:
            merge(spark, tables[0], STORED_EVENT, 1, LATER, "invoice_date")
            deleted = []

            def once(spark, path):
                if deleted:
                    crash()
                deleted.append(path)

            broken.setattr(generations, "delete", once)
        with pytest.raises(OSError, match="power cut"):
            if step == "drop":
                generations.drop_merged(spark, tables[0], 0)
            else:
                store.merge_closed_days(spark, 1, LATER, *tables)
    check(spark, tables, batches[:2])
    put(batches, (2,), tables)
    store.merge_closed_days(spark, 2, LATER, *tables)
    for table in tables:
        generations.drop_merged(spark, table, 0)
    check(spark, tables, batches)
    held = {m.generation for m in generations.read_manifest(spark, tables[0])[1].values()}
    assert set(generations.children(spark, f"{tables[0]}/_generations")) == held


def test_of_two_merges_at_once_one_is_refused(spark, tables, monkeypatch):
    batches = batches_of(spark, 2)
    put(batches, (0, 1), tables)
    real = generations.write_once

    def late(spark, path, text):
        assert real(spark, path, text)
        return real(spark, path, text)

    monkeypatch.setattr(generations, "write_once", late)
    with pytest.raises(RuntimeError, match="another job"):
        generations.merge_days(spark, tables[0], STORED_EVENT, 1, LATER, "invoice_date")
    check(spark, tables, batches)


def test_nothing_is_dropped_within_the_grace(spark, tables):
    batches = batches_of(spark, 1)
    put(batches, (0,), tables)
    assert generations.drop_merged(spark, tables[0], 0) == []
    store.merge_closed_days(spark, 0, LATER, *tables)
    assert generations.drop_merged(spark, tables[0], 3600) == []
    reader = store.read_events(spark, tables[0])
    assert reader.count() == batches[0].count()


def test_committed_batch(spark, tmp_path):
    assert generations.committed_batch(spark, str(tmp_path / "none")) == -1
    os.makedirs(tmp_path / "c" / "commits")
    for name in ("0", "1", "10", ".10.crc"):
        (tmp_path / "c" / "commits" / name).write_text("v1")
    assert generations.committed_batch(spark, str(tmp_path / "c")) == 10


def test_an_empty_table(spark, tables):
    assert store.read_events(spark, tables[0]).count() == 0
    assert store.merge_closed_days(spark, 5, LATER, *tables) == {t: [] for t in tables}
    assert store.read_piece_metrics(spark, tables[2]).count() == 0


def test_pieces_for_a_store_that_had_none(spark, tables):
    batches = batches_of(spark, 3)
    for batch_id in (0, 1):
        store_batch(batches[batch_id], batch_id, *tables[:2])
    store.backfill_pieces(spark, tables[0], tables[2], 1)
    put(batches, (2,), tables)
    check(spark, tables, batches)
    assert spark.read.schema(METRIC_PIECES).parquet(tables[2]).filter("batch_id = 0").count() == 0
