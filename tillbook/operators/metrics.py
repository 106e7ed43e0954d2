"""Five-minute order metrics.

Input lines carry ``invoice_no, stock_code, country, quantity, invoice_date, unit_price,
unit_price_usd``; lines without a time belong to no window.

A line's amount is its quantity times its unit price, to ten decimal places. Amounts are summed
as decimals, so a total is the same in whatever order lines arrive. An amount without a value (a
missing quantity or price, or a price that is no number) counts for nothing. If an amount of a
window, or their total, is 1e28 or more, the window keeps its counts and leaders, and its totals
in that currency are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.schemas import METRIC_WINDOW

AMOUNT = "decimal(38,10)"
_CURRENCIES = {"gbp": "unit_price", "usd": "unit_price_usd"}
KEYS = ["window_start", "window_end"]


def in_windows(lines: DataFrame, *columns: str | Column) -> DataFrame:
    """Lines with a time, as ``window_start`` and the given columns."""
    return lines.filter(F.col("invoice_date").isNotNull()).select(
        F.window("invoice_date", METRIC_WINDOW).start.alias("window_start"), *columns
    )


def window_end() -> Column:
    return (F.col("window_start") + F.expr(f"INTERVAL {METRIC_WINDOW}")).alias("window_end")


def _amounts() -> list[Column]:
    """Each currency's amount, and whether it is too large to have a decimal."""
    columns = []
    for name, unit_price in _CURRENCIES.items():
        amount = F.nanvl(F.col("quantity") * F.col(unit_price), F.lit(None))
        held = amount.try_cast(AMOUNT)
        columns += [
            held.alias(name),
            (amount.isNotNull() & held.isNull()).alias(f"{name}_lost"),
        ]
    return columns


def _sums(counted: Column | None = None) -> list[Column]:
    """Aggregates: sums of amounts or of such sums, and whether anything was too large.

    ``counted`` tells which rows to take, if not all.
    """
    columns = []
    for name in _CURRENCIES:
        value, lost = F.col(name), F.col(f"{name}_lost")
        if counted is not None:
            value, lost = F.when(counted, value), counted & lost
        total = F.try_sum(value)
        columns += [
            total.alias(name),
            (F.bool_or(lost) | (total.isNull() & (F.count(value) > 0))).alias(f"{name}_lost"),
        ]
    return columns


def _leader(total: Column, name: Column) -> Column:
    """Aggregate: the name with the highest total; the first in the alphabet if tied."""
    rank = F.struct(total.isNull(), -total, name.alias("name"))
    return F.min(F.when(name.isNotNull(), rank))["name"]


def _totals() -> list[Column]:
    """Summed amounts as money."""
    gbp, usd = (F.when(~F.col(f"{name}_lost"), F.col(name)) for name in _CURRENCIES)
    totals = {
        "total_revenue_gbp": gbp,
        "total_revenue_usd": usd,
        "avg_order_value": F.try_divide(gbp, F.col("priced")),
    }
    return [
        F.round(total, 2).try_cast("decimal(38,2)").alias(name)
        for name, total in totals.items()
    ]


def window_pieces(lines: DataFrame) -> DataFrame:
    """What the metrics of every window are made of, as ``METRIC_PIECES``.

    Grouping sets bring the lines down to distinct invoices, products and country invoices
    per window. Unlike metrics, pieces of two sets of lines can be put together by
    ``merge_pieces``.
    """
    start, invoice, code, country = "window_start", "invoice_no", "stock_code", "country"
    return (
        in_windows(lines, invoice, code, country, "quantity", *_amounts())
        .groupingSets(
            [[start, invoice], [start, code], [start, country, invoice]],
            *(start, invoice, code, country),
        )
        .agg(
            F.grouping_id().cast("int").alias("piece"),
            F.sum("quantity").alias("units"),
            *_sums(),
            F.count("gbp").alias("priced"),
        )
    )


def merge_pieces(pieces: DataFrame) -> DataFrame:
    """Pieces with one row for each window, kind and name again."""
    return pieces.groupBy("window_start", "piece", "invoice_no", "stock_code", "country").agg(
        F.sum("units").alias("units"), *_sums(), F.sum("priced").alias("priced")
    )


def pieces_metrics(pieces: DataFrame, stored: bool = False) -> DataFrame:
    """The metrics of every window from its pieces, each given once.

    Two small roll-ups; each combines before its shuffle and groups by more than the window
    until the last, so that a window with very many pieces is worked on by many tasks.

    Only products' amounts count. With ``stored``, for pieces that come from files, invoices are
    read apart from them, by name only, so that their amounts are neither merged nor shuffled.
    """
    start, invoice, code, country = "window_start", "invoice_no", "stock_code", "country"
    # grouping_id sets a bit for each column left out, the last column lowest.
    by_invoice = F.col("piece") == 0b0011
    by_code = F.col("piece") == 0b0101
    by_country = F.col("piece") == 0b0010
    counted = F.count(invoice).alias("invoices")
    summed = (F.sum("units").alias("units"), *_sums(), F.sum("priced").alias("priced"))
    keys = (start, "piece", code, country)
    if stored:
        invoices = pieces.filter(~by_code).groupBy(*keys).agg(counted)
        products = pieces.filter(by_code).groupBy(*keys).agg(*summed)
        rolled = products.unionByName(invoices, allowMissingColumns=True)
    else:
        rolled = pieces.groupBy(*keys).agg(counted, *summed)
    return (
        rolled.groupBy(start)
        .agg(
            F.sum(F.when(by_invoice, F.col("invoices"))).alias("order_count"),
            *_sums(by_code),
            F.sum(F.when(by_code, F.col("priced"))).alias("priced"),
            _leader(F.col("units"), F.when(by_code, F.col(code))).alias("top_product_code"),
            _leader(F.col("invoices"), F.when(by_country, F.col(country))).alias("top_country"),
        )
        .select(
            start,
            window_end(),
            "order_count",
            *_totals(),
            "top_product_code",
            "top_country",
        )
    )


def window_metrics(lines: DataFrame) -> DataFrame:
    """All metrics of every window, from one pass over the lines."""
    return pieces_metrics(window_pieces(lines))


def top_product(lines: DataFrame) -> DataFrame:
    """Per window, the stock code with the highest summed quantity."""
    units = in_windows(lines, "stock_code", "quantity").groupBy("window_start", "stock_code")
    return (
        units.agg(F.sum("quantity").alias("units"))
        .groupBy("window_start")
        .agg(_leader(F.col("units"), F.col("stock_code")).alias("top_product_code"))
    )


def top_country(lines: DataFrame) -> DataFrame:
    """Per window, the country with the most distinct invoices."""
    orders = in_windows(lines, "country", "invoice_no").groupBy("window_start", "country")
    return (
        orders.agg(F.countDistinct("invoice_no").alias("orders"))
        .groupBy("window_start")
        .agg(_leader(F.col("orders"), F.col("country")).alias("top_country"))
    )


def upsert(current: DataFrame, updates: DataFrame) -> DataFrame:
    """``current`` with the windows of ``updates`` replaced or added; one row per window."""
    values = [name for name in current.columns if name not in KEYS]
    tagged = current.withColumn("_update", F.lit(False)).unionByName(
        updates.withColumn("_update", F.lit(True))
    )
    latest = F.max_by(F.struct(*values), "_update").alias("latest")
    return tagged.groupBy(KEYS).agg(latest).select(*KEYS, "latest.*")


def streaming_window_metrics(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """All metrics of every window, leaders included, as append-mode streaming aggregations.

    Each line becomes three pieces, and three aggregations follow one another as in
    ``window_metrics``: distinct names within a window, totals of products and countries, and
    the window. All group by the window, so the watermark closes their states together, and
    they hold open windows only. A window appears once the watermark has passed it, and events
    later than ``delay`` are left out. ``run_order_stream`` keeps exact metrics of late events
    too.
    """
    names = ("invoice_no", "stock_code", "country")
    kinds = {"invoice": ("invoice_no",), "product": ("stock_code",), "country": ("country", "invoice_no")}
    piece = F.explode(F.array(*(F.lit(kind) for kind in kinds))).alias("piece")

    def of_kind(name: str) -> Column:
        held = [kind for kind, columns in kinds.items() if name in columns]
        return F.when(F.col("piece").isin(held), F.col(name)).alias(name)

    lines = (
        events.withWatermark("invoice_date", delay)
        .select("invoice_date", *names, "quantity", *_amounts(), piece)
        .select(
            F.window("invoice_date", METRIC_WINDOW).alias("span"),
            "piece",
            *(of_kind(name) for name in names),
            *("quantity", "gbp", "gbp_lost", "usd", "usd_lost"),
        )
    )
    pieces = lines.groupBy("span", "piece", *names).agg(
        F.sum("quantity").alias("units"), *_sums(), F.count("gbp").alias("priced")
    )

    def same_window() -> Column:
        return F.window(F.window_time("span"), METRIC_WINDOW).alias("span")

    rolled = pieces.groupBy(same_window(), "piece", "stock_code", "country").agg(
        F.count("invoice_no").alias("invoices"),
        F.sum("units").alias("units"),
        *_sums(),
        F.sum("priced").alias("priced"),
    )
    by_product = F.col("piece") == "product"
    product, country = (F.when(F.col("piece") == kind, F.col(name)) for kind, name in (("product", "stock_code"), ("country", "country")))
    per_window = rolled.groupBy(same_window()).agg(
        F.sum(F.when(F.col("piece") == "invoice", F.col("invoices"))).alias("order_count"),
        *_sums(by_product),
        F.sum(F.when(by_product, F.col("priced"))).alias("priced"),
        _leader(F.col("units"), product).alias("top_product_code"),
        _leader(F.col("invoices"), country).alias("top_country"),
    )
    return per_window.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        "order_count",
        *_totals(),
        "top_product_code",
        "top_country",
    )
