"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.orders import normalize_customer_id
from tillbook.operators import bucketed, clean, dims, events, fact, metrics, profile
from tillbook.plans.batch import run_batch
from tillbook.plans.revenue import revenue_by_region
from tillbook.schemas import ORDER_EVENT
from tillbook.session import new_folder
from tillbook.sinks.topic import write_events_to_folder
from tillbook.sources import fixtures, rates, tables
from tillbook.staging import stage
from tillbook.streaming import replay, store
from tillbook.streaming.generations import committed_batch, drop_merged
from tillbook.streaming.orders import run_order_stream
from tillbook.streaming.quarantine import read_quarantine
from tillbook.streaming.source import read_folder

Query = Callable[[SparkSession, str], DataFrame]

RAW_COLUMNS = (
    "Invoice",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "Price",
    "Customer ID",
    "Country",
)
# The rate correction of ``upsert_metrics`` starts at this moment.
RERATED_FROM = "2024-01-16 00:00:00"
RERATED = 1.5
# What ``batch_run`` sums of each table, in SQL.
STAR_SUMS = {
    "dim_customer": {
        "key_sum": "customer_key * total_orders",
        "value_sum": "year(last_purchase_date) * month(first_purchase_date)",
    },
    "dim_country": {
        "key_sum": "country_key * length(country_name)",
        "value_sum": "length(region) * length(currency_code)",
    },
    "dim_product": {
        "key_sum": "product_key * length(stock_code)",
        "value_sum": "CAST(avg_price_gbp AS DECIMAL(18,2))",
    },
    "dim_date": {"key_sum": "date_key", "value_sum": "day_of_week * length(day_name)"},
    "fact_orders": {
        "key_sum": "order_key * (customer_key + product_key + country_key)",
        "value_sum": "CAST(total_amount_usd AS DECIMAL(18,2))",
    },
}
# Days that are merged before a stream's second half of events, and after it.
MERGED_FIRST = "2024-01-21"
MERGED_LAST = "2024-01-11"
# The batches of ``paced_replay``, one a second.
REPLAY_SECONDS = 5
# The earlier run of ``continued_customers`` has the orders before this moment.
EARLIER_UNTIL = "1995-06-01 00:00:00"
BUCKETS = 16
_MESSAGES_PER_FILE = 1_000_000
_STREAM_BATCHES = 4


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_orders(
        fixtures.raw_orders(spark, sf_dir), fixtures.fx_rates(spark, sf_dir)
    )


def _enriched(spark: SparkSession, sf_dir: str, rate: float = fixtures.EVENT_RATE) -> DataFrame:
    messages = fixtures.order_messages(fixtures.order_events(spark, sf_dir))
    return events.enrich_events(events.parse_events(messages), rate)


def _plain_metrics(windows: DataFrame) -> DataFrame:
    """Money as doubles, for comparing across engines."""
    money = ("total_revenue_gbp", "total_revenue_usd", "avg_order_value")
    return windows.withColumns({name: F.col(name).cast("double") for name in money})


def land_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_orders(spark, sf_dir)
    unnamed = F.when(F.col("Quantity") % 7 == 0, "nan").otherwise(F.col("Description"))
    return tables.land_orders(raw.withColumn("Description", unnamed))


def flatten_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    quoted = F.when(F.dayofmonth("date") != 13, F.col("gbp_to_usd"))
    published = fixtures.fx_rates(spark, sf_dir).withColumn("gbp_to_usd", quoted)
    return rates.flatten_rates(fixtures.rate_responses(published))


def enrich_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = clean.standardize(fixtures.raw_orders(spark, sf_dir))
    priced = clean.enrich_fx(lines, fixtures.fx_rates(spark, sf_dir))
    return clean.add_usd(clean.add_totals(priced))


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stage(_cleaned(spark, sf_dir), "cleaned_orders")
    return fact.build_fact_orders(
        orders,
        dims.dim_customer(orders),
        dims.dim_product(orders),
        dims.dim_country(orders),
        stored=True,
    )


def _wide_sum(x: str) -> str:
    """A sum as a double, added up in 38 digits: products of keys soon exceed a bigint's."""
    return f"CAST(sum(CAST({x} AS DECIMAL(38,2))) AS DOUBLE)"


def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts and sums over keys and values of the star tables after a whole batch run."""
    star = run_batch(
        spark,
        fixtures.raw_orders(spark, sf_dir),
        fixtures.rate_responses(fixtures.fx_rates(spark, sf_dir)),
        new_folder(spark, "lake"),
    )
    counts = [
        table.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            *(F.expr(_wide_sum(x)).alias(c) for c, x in STAR_SUMS[name].items()),
        )
        for name, table in star.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.parse_events(events.to_event_json(fixtures.raw_orders(spark, sf_dir)))


def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed messages, with the customer ID also as the dimensions write it."""
    messages = fixtures.order_messages(fixtures.order_events(spark, sf_dir))
    return events.parse_events(messages).withColumn(
        "customer_key_text", normalize_customer_id(F.col("customer_id"))
    )


def upsert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of all windows, those from a moment on replaced at a corrected rate."""
    rerated = metrics.window_metrics(_enriched(spark, sf_dir, RERATED))
    since = F.to_timestamp(F.lit(RERATED_FROM))
    current = metrics.window_metrics(_enriched(spark, sf_dir))
    return _plain_metrics(
        metrics.upsert(current, rerated.filter(F.col("window_start") >= since))
    )


def _run_stream(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Stream all order events in four batches; the folders of events and metrics."""
    folder = new_folder(spark, "order_stream")
    source = fixtures.order_messages(fixtures.order_events(spark, sf_dir))
    messages = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    files = max(_STREAM_BATCHES, -(-messages // _MESSAGES_PER_FILE))
    write_events_to_folder(source.repartition(files), f"{folder}/messages")
    query = run_order_stream(
        read_folder(spark, f"{folder}/messages", -(-files // _STREAM_BATCHES)),
        f"{folder}/events",
        f"{folder}/metrics",
        f"{folder}/checkpoint",
        fixtures.EVENT_RATE,
        available_now=True,
    )
    query.awaitTermination()
    return f"{folder}/events", f"{folder}/metrics"


class _Folders(NamedTuple):
    """Where a stream of several starts keeps its tables."""

    root: str
    store: str
    metrics: str
    pieces: str
    quarantine: str
    checkpoint: str


def _stream_folders(spark: SparkSession) -> _Folders:
    root = new_folder(spark, "order_stream")
    return _Folders(root, *(f"{root}/{name}" for name in _Folders._fields[1:]))


def _go_on(spark: SparkSession, folders: _Folders, messages: DataFrame, strict: bool = False) -> None:
    """Send some messages and work them off in two batches."""
    files = max(_STREAM_BATCHES, -(-messages.count() // _MESSAGES_PER_FILE))
    write_events_to_folder(messages.repartition(files), f"{folders.root}/messages")
    run_order_stream(
        read_folder(spark, f"{folders.root}/messages", -(-files // 2)),
        folders.store,
        folders.metrics,
        folders.checkpoint,
        fixtures.EVENT_RATE,
        available_now=True,
        pieces=folders.pieces,
        quarantine=folders.quarantine,
        strict=strict,
    ).awaitTermination()


def _in_halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The messages of all order events in two halves, written once for both."""
    messages = fixtures.order_messages(fixtures.order_events(spark, sf_dir))
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    written = stage(messages.withColumn("half", half), "messages")
    return [written.filter(F.col("half") == turn).select("value") for turn in (0, 1)]


def _merged_stream(spark: SparkSession, sf_dir: str) -> _Folders:
    """A stream of all order events, some days of which are merged while it still goes on.

    After the first half of the events, two thirds of the days are merged and their batches
    dropped; the second half brings late events for all of them. Then other days are merged.
    """
    folders = _stream_folders(spark)
    tables = (folders.store, folders.metrics, folders.pieces)
    halves = _in_halves(spark, sf_dir)
    for messages, before in zip(halves, (MERGED_FIRST, MERGED_LAST), strict=True):
        _go_on(spark, folders, messages)
        committed = committed_batch(spark, folders.checkpoint)
        store.merge_closed_days(spark, committed, before, *tables)
        for table in tables:
            drop_merged(spark, table, 0)
    return folders


def stream_compacted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = _merged_stream(spark, sf_dir)
    return store.read_events(spark, folders.store).drop("batch_id")


def stream_compacted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of merged and later batches, as the stream has kept them."""
    folders = _merged_stream(spark, sf_dir)
    return _plain_metrics(store.read_metrics(spark, folders.metrics))


def stream_piece_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics put together from the pieces of all batches, a half of the events a start."""
    folders = _stream_folders(spark)
    for messages in _in_halves(spark, sf_dir):
        _go_on(spark, folders, messages)
    return _plain_metrics(store.read_piece_metrics(spark, folders.pieces))


def _damaged_stream(spark: SparkSession, sf_dir: str) -> _Folders:
    folders = _stream_folders(spark)
    _go_on(spark, folders, fixtures.damaged_messages(spark, sf_dir), strict=True)
    return folders


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that a stream could not read, a text file's empty and missing ones alike."""
    folders = _damaged_stream(spark, sf_dir)
    return read_quarantine(spark, folders.quarantine).select("reason", "value")


def stream_readable_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that the same stream has stored."""
    folders = _damaged_stream(spark, sf_dir)
    return store.read_events(spark, folders.store).drop("batch_id")


def stream_append_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _ = _run_stream(spark, sf_dir)
    return store.read_events(spark, stored).drop("batch_id")


def stream_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, stored = _run_stream(spark, sf_dir)
    return _plain_metrics(store.read_metrics(spark, stored))


def closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that a watermarked stream has closed after all order events."""
    folder = new_folder(spark, "watermarked")
    source = fixtures.order_messages(fixtures.order_events(spark, sf_dir))
    write_events_to_folder(source, f"{folder}/messages")
    messages = read_folder(spark, f"{folder}/messages")
    enriched = events.enrich_events(events.parse_events(messages), fixtures.EVENT_RATE)
    query = (
        metrics.streaming_window_metrics(enriched)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/metrics")
    )
    query.awaitTermination()
    return _plain_metrics(spark.read.parquet(f"{folder}/metrics"))


def paced_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each second of a replay has sent: all lines, in order, in ``REPLAY_SECONDS``."""
    numbered = replay.number_lines(fixtures.raw_orders(spark, sf_dir))
    folder = new_folder(spark, "replay")
    pace = -(-numbered.count() // REPLAY_SECONDS)
    replay.run_paced_replay(
        numbered, replay.to_folder(f"{folder}/messages"), f"{folder}/checkpoint", pace
    )
    sent = spark.read.schema("value string, batch bigint").text(f"{folder}/messages")
    batch = F.col("batch").cast("bigint").alias("batch")
    values = sent.select(batch, F.from_json("value", ORDER_EVENT).alias("e")).select("batch", "e.*")
    return values.groupBy("batch").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
        F.min("invoice_date").alias("first_time"),
        F.max("invoice_date").alias("last_time"),
        F.count_distinct("invoice_no").alias("invoices"),
    )


def _earlier(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("invoice_date") < F.to_timestamp(F.lit(EARLIER_UNTIL)))


def continued_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of all orders, with the keys of an earlier run going on."""
    orders = stage(_cleaned(spark, sf_dir), "cleaned_orders")
    return dims.dim_customer(orders, dims.dim_customer(_earlier(orders)))


def continued_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of the later orders, behind those of an earlier run, which stay."""
    orders = stage(_cleaned(spark, sf_dir), "cleaned_orders")
    later = orders.filter(F.col("invoice_date") >= F.to_timestamp(F.lit(EARLIER_UNTIL)))
    return dims.dim_product(later, dims.dim_product(_earlier(orders)))


def row_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines cleaning and key lookup drop, and why, counted while they run.

    The fact is built with dimensions that lack some customers and products.
    """
    cleaning, lookup = Observation(), Observation()
    raw = fixtures.raw_orders(spark, sf_dir)
    orders = stage(
        clean.clean_orders(raw, fixtures.fx_rates(spark, sf_dir), counts=cleaning), "cleaned_orders"
    )
    fact.build_fact_orders(
        orders,
        dims.dim_customer(orders.filter("customer_id NOT LIKE '%3'")),
        dims.dim_product(orders.filter("stock_code NOT LIKE '%7'")),
        dims.dim_country(orders),
        stored=True,
        counts=lookup,
    )
    counted = [
        (step, reason, lines)
        for step, counts in (("clean", cleaning), ("fact", lookup))
        for reason, lines in counts.get.items()
    ]
    return spark.createDataFrame(counted, "step string, reason string, lines bigint")


def bucketed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their customer's key, both sides stored in buckets."""
    orders = stage(_cleaned(spark, sf_dir), "cleaned_orders")
    folder = new_folder(spark, "bucketed")
    lines = bucketed.write_bucketed(
        orders.select("customer_id", "invoice_no", "stock_code", "quantity"),
        f"{folder}/orders", "customer_id", BUCKETS,
    )
    customers = bucketed.write_bucketed(
        dims.dim_customer(orders), f"{folder}/customers", "customer_id", BUCKETS, split_hot=False
    )
    return bucketed.lookup_bucketed(spark, lines, customers, "customer_key")


def _raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(fixtures.raw_orders(spark, sf_dir))


def _standard(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _raw(lambda raw: operator(clean.standardize(raw)))


def _orders(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_cleaned(spark, sf_dir))


def _lines(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_enriched(spark, sf_dir))


def _rates(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(fixtures.fx_rates(spark, sf_dir))


def _preview(raw: DataFrame) -> DataFrame:
    first = ("InvoiceDate", "Invoice", "StockCode")
    return profile.preview(raw, (*first, *(c for c in RAW_COLUMNS if c not in first)))


QUERIES: dict[str, Query] = {
    "raw_orders": fixtures.raw_orders,
    "fx_rates": fixtures.fx_rates,
    "land_orders": land_orders,
    "flatten_rates": flatten_rates,
    "latest_rate": _rates(rates.latest_rate),
    "standardize_orders": _raw(clean.standardize),
    "drop_bad_rows": _raw(clean.drop_bad_rows),
    "flag_cancelled": _standard(clean.flag_cancelled),
    "line_totals": _standard(clean.add_totals),
    "enrich_fx": enrich_fx,
    "clean_orders": _cleaned,
    "dim_customer": _orders(dims.dim_customer),
    "dim_country": _orders(dims.dim_country),
    "dim_product": _orders(dims.dim_product),
    "dim_date": _orders(dims.dim_date),
    "fact_orders": fact_orders,
    "batch_run": batch_run,
    "revenue_by_region": _orders(revenue_by_region),
    "null_counts": _raw(profile.null_counts),
    "table_shape": _raw(profile.shape),
    "preview_orders": _raw(_preview),
    "customer_copy": _raw(profile.with_customer_copy),
    "top_countries": _raw(profile.top_countries),
    "top_invoices": _raw(profile.top_invoices),
    "dated_rates": _rates(profile.dated_rates),
    "event_json": event_json,
    "replay_slice": _raw(events.replay_slice),
    "parse_events": parse_events,
    "enrich_events": _enriched,
    "window_metrics": _lines(lambda lines: _plain_metrics(metrics.window_metrics(lines))),
    "window_top_product": _lines(metrics.top_product),
    "window_top_country": _lines(metrics.top_country),
    "upsert_metrics": upsert_metrics,
    "stream_append_events": stream_append_events,
    "stream_window_metrics": stream_window_metrics,
    "stream_closed_windows": closed_windows,
    "stream_compacted_events": stream_compacted_events,
    "stream_compacted_metrics": stream_compacted_metrics,
    "stream_piece_metrics": stream_piece_metrics,
    "paced_replay": paced_replay,
    "continued_customers": continued_customers,
    "continued_products": continued_products,
    "row_accounting": row_accounting,
    "bucketed_lookup": bucketed_lookup,
    "stream_quarantine": stream_quarantine,
    "stream_readable_events": stream_readable_events,
}
