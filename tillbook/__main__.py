"""The jobs as commands, for ``spark-submit`` or ``python -m tillbook``."""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tillbook.operators.events import replay_slice, to_event_json
from tillbook.plans import batch
from tillbook.schemas import REPLAY_ROWS, REPLAY_ROWS_PER_SECOND
from tillbook.session import build_session
from tillbook.sinks.topic import write_events_to_folder, write_events_to_kafka
from tillbook.sinks.warehouse import refresh_star, refresh_table
from tillbook.sources.rates import latest_rate, read_responses
from tillbook.sources.tables import read_orders_csv, read_table
from tillbook.streaming.generations import committed_batch, drop_merged
from tillbook.streaming.orders import run_order_stream
from tillbook.streaming.replay import number_lines, run_paced_replay, to_folder, to_topic
from tillbook.streaming.source import read_folder, read_topic
from tillbook.streaming.store import merge_closed_days, read_metrics


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.orders.endswith(".csv"):
        orders = read_orders_csv(spark, args.orders)
    else:
        orders = read_table(spark, args.orders)
    batch.land(orders, read_responses(spark, args.responses), args.lake)


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    batch.clean(spark, args.lake)


def star(spark: SparkSession, args: argparse.Namespace) -> None:
    batch.build_star(spark, args.lake, args.keep_keys)


def _warehouse_login() -> dict[str, str]:
    login = {"user": "WAREHOUSE_USER", "password": "WAREHOUSE_PASSWORD"}
    return {key: os.environ[name] for key, name in login.items() if name in os.environ}


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    names = (*batch.DIMENSIONS, "fact_orders")
    tables = {name: batch.star_table(spark, args.lake, name) for name in names}
    refresh_star(tables, args.url, _warehouse_login())


def publish_metrics(spark: SparkSession, args: argparse.Namespace) -> None:
    metrics = read_metrics(spark, f"{args.lake}/processed/metrics")
    refresh_table(metrics, "realtime_metrics", args.url, _warehouse_login())


def replay(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = replay_slice(batch.raw_orders(spark, args.lake), args.mode)
    if args.paced:
        pace = args.rows_per_second or REPLAY_ROWS_PER_SECOND[args.mode]
        send = to_folder(args.folder) if args.folder else to_topic(args.servers, args.topic)
        checkpoint = f"{args.lake}/checkpoints/replay_{args.mode}"
        run_paced_replay(number_lines(lines), send, checkpoint, pace)
        return
    messages = to_event_json(lines)
    if args.folder:
        write_events_to_folder(messages, args.folder)
    else:
        write_events_to_kafka(messages, args.servers, args.topic)


def _stream_tables(lake: str) -> dict[str, str]:
    names = {"store": "streaming", "metrics": "metrics", "pieces": "metric_pieces"}
    return {key: f"{lake}/processed/{name}" for key, name in names.items()}


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = _stream_tables(args.lake)
    committed = committed_batch(spark, f"{args.lake}/checkpoints/order_stream")
    before = args.before or datetime.now(timezone.utc).date().isoformat()
    merge_closed_days(spark, committed, before, **tables)
    for table in tables.values():
        drop_merged(spark, table, args.grace_hours * 3600)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    rate = args.rate
    if rate is None:
        rate = latest_rate(batch.exchange_rates(spark, args.lake)).first()["gbp_to_usd"]
    if args.folder:
        messages = read_folder(spark, args.folder)
    else:
        messages = read_topic(spark, args.servers, args.topic)
    tables = _stream_tables(args.lake)
    run_order_stream(
        messages,
        tables["store"],
        tables["metrics"],
        f"{args.lake}/checkpoints/order_stream",
        rate,
        pieces=tables["pieces"],
        quarantine=f"{args.lake}/processed/unreadable",
        available_now=args.available_now,
        fractional=args.fractional,
        interval=args.trigger,
    ).awaitTermination()


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillbook")
    commands = parser.add_subparsers(required=True)

    def command(job, text: str) -> argparse.ArgumentParser:
        added = commands.add_parser(job.__name__.replace("_", "-"), help=text)
        added.set_defaults(job=job)
        added.add_argument("--lake", required=True, help="root folder of the tables")
        return added

    def messages(added: argparse.ArgumentParser) -> None:
        added.add_argument("--folder", help="message files instead of Kafka")
        added.add_argument("--servers", help="Kafka bootstrap servers")
        added.add_argument("--topic", default="orders.raw")

    landing = command(land, "land raw orders and exchange rates")
    landing.add_argument("--orders", required=True, help="a .csv path or a Parquet table")
    landing.add_argument("--responses", required=True, help="rate response JSON files")
    command(clean, "clean the landed orders")
    building = command(star, "build the star schema")
    building.add_argument("--keep-keys", action="store_true", help="go on from the keys there are")
    compacting = command(compact, "merge the stream's closed days into few files")
    compacting.add_argument("--before", help="days before this date, by default before today")
    compacting.add_argument(
        "--grace-hours", type=float, default=24, help="how long merged batches are kept for readers"
    )
    for job, text in (
        (publish, "load the star schema into the warehouse"),
        (publish_metrics, "load the window metrics into the warehouse"),
    ):
        command(job, text).add_argument("--url", required=True, help="JDBC URL")
    replaying = command(replay, "send landed orders as messages")
    replaying.add_argument("--mode", choices=sorted(REPLAY_ROWS), default="test")
    replaying.add_argument("--paced", action="store_true", help="in order, so many a second")
    replaying.add_argument("--rows-per-second", type=int, help="default: the mode's pace")
    messages(replaying)
    streaming = command(stream, "store events and keep window metrics")
    streaming.add_argument("--rate", type=float, help="default: the last landed rate")
    streaming.add_argument("--available-now", action="store_true", help="stop when done")
    streaming.add_argument("--trigger", help='time between batches, such as "1 minute"')
    streaming.add_argument(
        "--fractional", action="store_true", help="read event times with fractions of seconds"
    )
    messages(streaming)

    args = parser.parse_args(argv)
    if getattr(args, "folder", "") is None and args.servers is None:
        parser.error("give --folder or --servers")
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = parse(argv)
    args.job(build_session(), args)


if __name__ == "__main__":
    main()
