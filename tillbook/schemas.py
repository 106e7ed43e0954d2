"""Table schemas and fixed business values."""

from __future__ import annotations

from pyspark.sql import types as T

# They decide results, so they must not be changed.
BATCH_FALLBACK_RATE = 1.5
STREAM_FALLBACK_RATE = 1.27
ANOMALY_AMOUNT = 5000
METRIC_WINDOW = "5 minutes"
METRIC_WINDOW_SECONDS = 300
NON_PRODUCT_CODE = "^[a-zA-Z]+$"
CANCELLED_PREFIX = "C"
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
REPLAY_ROWS = {"test": 100, "full": None}
REPLAY_ROWS_PER_SECOND = {"test": 5, "full": 200}
RFM_SEGMENT = "Active"
PRODUCT_CATEGORY = "General"
HOME_COUNTRY = "United Kingdom"
EUROPE = (
    "EIRE", "Germany", "France", "Netherlands", "Spain", "Switzerland",
    "Portugal", "Belgium", "Channel Islands", "Sweden", "Italy", "Cyprus",
    "Austria", "Denmark", "Norway", "Finland", "Greece", "Poland",
    "Malta", "Lithuania", "Iceland",
)

RAW_ORDERS = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.LongType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Customer ID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)

RATES = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("gbp_to_usd", T.DoubleType()),
    ]
)

# date -> currency -> rate, as published for a span of days.
RATE_RESPONSE = T.StructType(
    [
        T.StructField(
            "rates", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))
        )
    ]
)

ORDER_EVENT = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

# An enriched event as stored, with its two partition columns.
STORED_EVENT = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("unit_price_usd", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

WINDOW_METRICS = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("order_count", T.LongType()),
        T.StructField("total_revenue_gbp", T.DecimalType(38, 2)),
        T.StructField("total_revenue_usd", T.DecimalType(38, 2)),
        T.StructField("avg_order_value", T.DecimalType(38, 2)),
        T.StructField("top_product_code", T.StringType()),
        T.StructField("top_country", T.StringType()),
    ]
)

STORED_METRICS = T.StructType(
    [
        *WINDOW_METRICS.fields,
        T.StructField("date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# What window metrics are put together from, by batch: a distinct invoice, product, or invoice of
# a country in a window, as ``piece`` tells.
METRIC_PIECES = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("invoice_no", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("units", T.LongType()),
        T.StructField("gbp", T.DecimalType(38, 10)),
        T.StructField("gbp_lost", T.BooleanType()),
        T.StructField("usd", T.DecimalType(38, 10)),
        T.StructField("usd_lost", T.BooleanType()),
        T.StructField("priced", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# Messages that could not be read.
QUARANTINED = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# Column types of the relational warehouse that differ from those of the lake tables.
WAREHOUSE_TYPES = {
    "dim_customer": {"total_orders": "int"},
    "dim_product": {"avg_price_gbp": "decimal(10,2)"},
    "fact_orders": {
        "quantity": "int",
        "unit_price_gbp": "decimal(10,2)",
        "unit_price_usd": "decimal(10,2)",
        "total_amount_gbp": "decimal(12,2)",
        "total_amount_usd": "decimal(12,2)",
        "exchange_rate": "decimal(10,6)",
    },
    "realtime_metrics": {
        "order_count": "int",
        "total_revenue_gbp": "decimal(12,2)",
        "total_revenue_usd": "decimal(12,2)",
        "avg_order_value": "decimal(10,2)",
    },
}
