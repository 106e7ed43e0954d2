"""The catalog's queries in SQL, for checking results on another engine."""

from __future__ import annotations

from tillbook.plans.catalog import (
    EARLIER_UNTIL,
    REPLAY_SECONDS,
    RERATED,
    RERATED_FROM,
    STAR_SUMS,
)
from tillbook.schemas import EUROPE
from tillbook.sources.fixtures import COUNTRIES, DAMAGED_EVERY, EVENT_RATE


def _names(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{name}'" for name in names)


_COUNTRY_LIST = f"[{_names(COUNTRIES)}]"

_RAW = f"""raw AS (
  SELECT CASE WHEN l_orderkey % 50 = 0 THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR)
           AS "Invoice",
         CASE WHEN l_partkey % 40 = 0 THEN 'POST'
              WHEN l_partkey % 40 = 1 THEN 'BANK CHARGES'
              ELSE CAST(l_partkey AS VARCHAR) || CASE WHEN l_partkey % 5 = 0 THEN 'A' ELSE '' END
         END AS "StockCode",
         p_name AS "Description",
         CASE WHEN l_orderkey % 50 = 0 THEN -CAST(l_quantity AS BIGINT)
              ELSE CAST(l_quantity AS BIGINT) END AS "Quantity",
         CAST(o_orderdate AS TIMESTAMP) AS "InvoiceDate",
         CAST(p_size * 4 + 0.25 AS DOUBLE) AS "Price",
         CASE WHEN o_custkey % 4 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS "Customer ID",
         {_COUNTRY_LIST}[CASE WHEN c_nationkey >= 0 THEN c_nationkey + 1 END] AS "Country"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
)"""

_RATES = """rates AS (
  SELECT d AS "date",
         1.25::DOUBLE + (datediff('day', DATE '1995-01-02', d) % 32) / 64.0::DOUBLE AS gbp_to_usd
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
  WHERE (datediff('day', DATE '1995-01-02', d) + 7) % 7 < 5
)"""

_STANDARD_COLUMNS = """"Invoice" AS invoice_no, "StockCode" AS stock_code,
  "Description" AS description, "Quantity" AS quantity, "InvoiceDate" AS invoice_date,
  "Price" AS unit_price_gbp, CAST(CAST("Customer ID" AS BIGINT) AS VARCHAR) AS customer_id,
  "Country" AS country"""

_KEPT = """"Customer ID" IS NOT NULL AND NOT regexp_matches("StockCode", '^[a-zA-Z]+$')"""

_STANDARD = f"standard AS (SELECT {_STANDARD_COLUMNS} FROM raw)"

_CLEAN = f"""priced AS (
  SELECT k.*, starts_with(invoice_no, 'C') AS is_cancelled,
         quantity * unit_price_gbp AS total_amount_gbp,
         coalesce(r.gbp_to_usd, 1.5) AS gbp_to_usd
  FROM (SELECT {_STANDARD_COLUMNS} FROM raw WHERE {_KEPT}) k
  LEFT JOIN rates r ON r."date" = CAST(k.invoice_date AS DATE)
), cleaned AS (
  SELECT *, round(unit_price_gbp * gbp_to_usd, 2) AS unit_price_usd,
         round(total_amount_gbp * gbp_to_usd, 2) AS total_amount_usd
  FROM priced
)"""


def _by_region(country: str, home: str, europe: str, elsewhere: str) -> str:
    return (
        f"CASE WHEN {country} = 'United Kingdom' THEN '{home}' "
        f"WHEN {country} IN ({_names(EUROPE)}) THEN '{europe}' ELSE '{elsewhere}' END"
    )


_REGION = _by_region("country", "UK", "Europe", "Rest of World")
_CURRENCY = _by_region("country", "GBP", "EUR", "USD")

_CUSTOMERS = """customers AS (
  SELECT customer_id, max(country) AS country,
         CAST(min(invoice_date) AS DATE) AS first_purchase_date,
         CAST(max(invoice_date) AS DATE) AS last_purchase_date,
         count(DISTINCT invoice_no) AS total_orders,
         CAST(row_number() OVER (ORDER BY customer_id NULLS FIRST) AS INTEGER) AS customer_key,
         'Active' AS rfm_segment
  FROM cleaned GROUP BY customer_id
)"""

_PRODUCTS = """products AS (
  SELECT stock_code, max(description) AS description,
         round(avg(unit_price_gbp), 2) AS avg_price_gbp,
         CAST(row_number() OVER (ORDER BY stock_code NULLS FIRST) AS INTEGER) AS product_key,
         'General' AS category
  FROM cleaned GROUP BY stock_code
)"""

_COUNTRY_DIM = f"""countries AS (
  SELECT country AS country_name, {_REGION} AS region, {_CURRENCY} AS currency_code,
         CAST(row_number() OVER (ORDER BY country NULLS FIRST) AS INTEGER) AS country_key
  FROM (SELECT DISTINCT country FROM cleaned)
)"""

_DATE_KEY = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"

_DATE_DIM = f"""dates AS (
  SELECT d AS full_date, {_DATE_KEY.format("d")} AS date_key,
         CAST(isodow(d) - 1 AS SMALLINT) AS day_of_week, dayname(d) AS day_name,
         CAST(month(d) AS SMALLINT) AS "month", monthname(d) AS month_name,
         CAST(quarter(d) AS SMALLINT) AS quarter, CAST(year(d) AS SMALLINT) AS "year",
         isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT DISTINCT CAST(invoice_date AS DATE) AS d FROM cleaned)
)"""

_FACT = f"""fact AS (
  SELECT row_number() OVER (
           ORDER BY invoice_no, stock_code, customer_key, country_key, invoice_date, quantity,
                    unit_price_gbp, unit_price_usd, total_amount_gbp, total_amount_usd,
                    gbp_to_usd, is_cancelled) AS order_key,
         invoice_no, customer_key, product_key, {_DATE_KEY.format("invoice_date")} AS date_key,
         country_key, quantity, unit_price_gbp, unit_price_usd, total_amount_gbp,
         total_amount_usd, gbp_to_usd AS exchange_rate, is_cancelled, FALSE AS is_anomaly,
         invoice_date AS event_timestamp
  FROM cleaned
  JOIN (SELECT customer_id, customer_key FROM customers) USING (customer_id)
  JOIN (SELECT stock_code, product_key FROM products) USING (stock_code)
  JOIN (SELECT country_name, country_key FROM countries) ON country = country_name
)"""

_EVENTS = f"""order_events AS (
  SELECT CASE WHEN event_type = 'error' THEN 'C' ELSE '' END
           || CAST(event_id // 2 AS VARCHAR) AS invoice_no,
         regexp_extract(props, '"k": *([0-9]+)', 1) AS stock_code,
         event_type AS description,
         CAST(CASE WHEN event_type = 'error' THEN -(1 + event_id % 12)
                   ELSE 1 + event_id % 12 END AS INTEGER) AS quantity,
         date_trunc('second', ts) AS moment,
         floor(value * 4) / 4 * 10 AS unit_price,
         CAST(user_id AS VARCHAR) || '.0' AS customer_id,
         {_COUNTRY_LIST}[user_id % 25 + 1] AS country
  FROM events
)"""

_UNDAMAGED = _EVENTS.replace("FROM events", f"FROM events WHERE event_id % {DAMAGED_EVERY} >= 6")


def _enriched(rate: float, name: str = "enriched") -> str:
    return f"""{name} AS (
  SELECT invoice_no, stock_code, description, quantity, CAST(moment AS TIMESTAMP) AS invoice_date,
         unit_price, customer_id, country,
         round(unit_price * {rate}::DOUBLE, 2) AS unit_price_usd,
         quantity < 0 OR quantity * unit_price > 5000 AS is_anomaly
  FROM order_events
)"""


def _metrics(source: str = "enriched", name: str = "metrics") -> str:
    return f"""{name} AS (
  SELECT b.window_start, b.window_start + INTERVAL 5 MINUTE AS window_end, b.order_count,
         b.total_revenue_gbp, b.total_revenue_usd, b.avg_order_value, p.top_product_code,
         c.top_country
  FROM (SELECT time_bucket(INTERVAL '5 minutes', invoice_date) AS window_start,
               count(DISTINCT invoice_no) AS order_count,
               CAST(sum(CAST(quantity * unit_price AS DECIMAL(18,2))) AS DOUBLE)
                 AS total_revenue_gbp,
               CAST(sum(CAST(quantity * unit_price_usd AS DECIMAL(18,2))) AS DOUBLE)
                 AS total_revenue_usd,
               round(CAST(sum(CAST(quantity * unit_price AS DECIMAL(18,2))) AS DOUBLE)
                     / count(*), 2) AS avg_order_value
        FROM {source} GROUP BY 1) b
  JOIN (SELECT window_start, stock_code AS top_product_code
        FROM (SELECT window_start, stock_code, row_number() OVER (
                       PARTITION BY window_start ORDER BY units DESC, stock_code) AS place
              FROM (SELECT time_bucket(INTERVAL '5 minutes', invoice_date) AS window_start,
                           stock_code, sum(quantity) AS units
                    FROM {source} GROUP BY 1, 2))
        WHERE place = 1) p USING (window_start)
  JOIN (SELECT window_start, country AS top_country
        FROM (SELECT window_start, country, row_number() OVER (
                       PARTITION BY window_start ORDER BY orders DESC, country) AS place
              FROM (SELECT time_bucket(INTERVAL '5 minutes', invoice_date) AS window_start,
                           country, count(DISTINCT invoice_no) AS orders
                    FROM {source} GROUP BY 1, 2))
        WHERE place = 1) c USING (window_start)
)"""


def _with(*steps: str, select: str) -> str:
    return f"WITH {', '.join(steps)}\n{select}"


def _raw_sql(select: str) -> str:
    return _with(_RAW, select=select)


def _clean_sql(*steps: str, select: str) -> str:
    return _with(_RAW, _RATES, _CLEAN, *steps, select=select)


def _event_sql(*steps: str, select: str) -> str:
    return _with(_EVENTS, _enriched(EVENT_RATE), *steps, select=select)


_FIRST_LINES = (
    'SELECT * FROM raw ORDER BY "InvoiceDate", "Invoice", "StockCode", "Description", '
    '"Quantity", "Price", "Customer ID" NULLS LAST, "Country" LIMIT {0}'
)

_EVENT_TIME = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"

_PARSED = f"""SELECT invoice_no, stock_code, description, quantity,
  {_EVENT_TIME.format("moment")} AS invoice_date, unit_price, customer_id, country,
  CAST(CAST(CAST(customer_id AS DOUBLE) AS BIGINT) AS VARCHAR) AS customer_key_text
FROM order_events"""

_RAW_AS_EVENTS = f"""SELECT "Invoice" AS invoice_no, "StockCode" AS stock_code,
  coalesce("Description", '') AS description, CAST("Quantity" AS INTEGER) AS quantity,
  {_EVENT_TIME.format('"InvoiceDate"')} AS invoice_date, "Price" AS unit_price,
  coalesce(CAST(CAST("Customer ID" AS BIGINT) AS VARCHAR) || '.0', '') AS customer_id,
  "Country" AS country
FROM raw"""

_NULL_COUNTS = "\nUNION ALL ".join(
    f"""SELECT '{name}' AS column_name, count(*) - count("{name}") AS null_count FROM raw"""
    for name in (
        "Invoice",
        "StockCode",
        "Description",
        "Quantity",
        "InvoiceDate",
        "Price",
        "Customer ID",
        "Country",
    )
)

_STAR = (("customers", "dim_customer"), ("countries", "dim_country"))
_STAR += (("products", "dim_product"), ("dates", "dim_date"), ("fact", "fact_orders"))
_STAR_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS row_count, "
    + ", ".join(f"CAST(sum({x}) AS DOUBLE) AS {c}" for c, x in STAR_SUMS[table].items())
    + f" FROM {step}"
    for step, table in _STAR
)

_APPENDED = "SELECT *, CAST(invoice_date AS DATE) AS \"date\" FROM enriched"

_REPLAYED = f"""SELECT CAST(place // pace AS BIGINT) AS batch, count(*) AS lines,
  CAST(sum("Quantity") AS BIGINT) AS units,
  {_EVENT_TIME.format('min("InvoiceDate")')} AS first_time,
  {_EVENT_TIME.format('max("InvoiceDate")')} AS last_time,
  count(DISTINCT "Invoice") AS invoices
FROM (SELECT *, row_number() OVER (ORDER BY "InvoiceDate" NULLS FIRST, "Invoice" NULLS FIRST,
               "StockCode" NULLS FIRST, "Description" NULLS FIRST, "Quantity" NULLS FIRST,
               "Price" NULLS FIRST, "Customer ID" NULLS FIRST, "Country" NULLS FIRST) - 1 AS place,
             (count(*) OVER () + {REPLAY_SECONDS - 1}) // {REPLAY_SECONDS} AS pace
      FROM raw)
GROUP BY 1"""


def _numbered(business: str, key: str) -> str:
    """Business keys of an earlier and a later run with keys that go on."""
    return f"""numbered AS (
  SELECT {business}, CAST(row_number() OVER (ORDER BY late, {business}) AS INTEGER) AS {key}
  FROM (SELECT {business}, min(invoice_date) >= TIMESTAMP '{EARLIER_UNTIL}' AS late
        FROM cleaned GROUP BY 1))"""


# Cleaned orders of one of two runs, for the steps that read ``cleaned``.
def _part(name: str, condition: str) -> str:
    return f"{name} AS (SELECT * FROM cleaned WHERE invoice_date {condition} TIMESTAMP '{EARLIER_UNTIL}')"


_ROW_ACCOUNTING = """marked AS (
  SELECT CASE WHEN "Customer ID" IS NULL THEN 'no customer'
              WHEN "StockCode" IS NULL THEN 'no stock code'
              WHEN regexp_full_match("StockCode", '[a-zA-Z]+') THEN 'not a product'
              ELSE 'kept' END AS reason FROM raw),
looked AS (
  SELECT CASE WHEN country IS NULL THEN 'no country'
              WHEN stock_code LIKE '%7' THEN 'no product'
              WHEN customer_id LIKE '%3' THEN 'no customer'
              ELSE 'kept' END AS reason FROM cleaned)"""
_ROW_COUNTS = """SELECT step, reason, count(r) AS lines FROM (VALUES
  ('clean', 'no customer'), ('clean', 'no stock code'), ('clean', 'not a product'),
  ('clean', 'kept'), ('fact', 'no country'), ('fact', 'no product'), ('fact', 'no customer'),
  ('fact', 'kept')) AS v(step, reason)
LEFT JOIN (SELECT 'clean' AS s, reason AS r FROM marked
           UNION ALL SELECT 'fact', reason FROM looked) ON s = step AND r = reason
GROUP BY 1, 2"""

ORACLES: dict[str, str] = {
    "raw_orders": _raw_sql("SELECT * FROM raw"),
    "fx_rates": _with(_RATES, select="SELECT * FROM rates"),
    "land_orders": _raw_sql(
        'SELECT * REPLACE (CASE WHEN "Quantity" % 7 <> 0 THEN "Description" END '
        'AS "Description") FROM raw'
    ),
    "flatten_rates": _with(
        _RATES,
        select='SELECT "date", CASE WHEN day("date") <> 13 THEN gbp_to_usd END AS gbp_to_usd '
        "FROM rates",
    ),
    "latest_rate": _with(
        _RATES,
        select='SELECT coalesce(arg_max(gbp_to_usd, "date"), 1.27) AS gbp_to_usd FROM rates',
    ),
    "standardize_orders": _raw_sql(f"SELECT {_STANDARD_COLUMNS} FROM raw"),
    "drop_bad_rows": _raw_sql(f"SELECT * FROM raw WHERE {_KEPT}"),
    "flag_cancelled": _with(
        _RAW,
        _STANDARD,
        select="SELECT *, starts_with(invoice_no, 'C') AS is_cancelled FROM standard",
    ),
    "line_totals": _with(
        _RAW,
        _STANDARD,
        select="SELECT *, quantity * unit_price_gbp AS total_amount_gbp FROM standard",
    ),
    "enrich_fx": _with(
        _RAW,
        _RATES,
        _STANDARD,
        select="""SELECT *, round(unit_price_gbp * gbp_to_usd, 2) AS unit_price_usd,
  round(total_amount_gbp * gbp_to_usd, 2) AS total_amount_usd
FROM (SELECT s.*, coalesce(r.gbp_to_usd, 1.5) AS gbp_to_usd,
             quantity * unit_price_gbp AS total_amount_gbp
      FROM standard s LEFT JOIN rates r ON r."date" = CAST(s.invoice_date AS DATE))""",
    ),
    "clean_orders": _clean_sql(select="SELECT * FROM cleaned"),
    "dim_customer": _clean_sql(_CUSTOMERS, select="SELECT * FROM customers"),
    "dim_country": _clean_sql(_COUNTRY_DIM, select="SELECT * FROM countries"),
    "dim_product": _clean_sql(_PRODUCTS, select="SELECT * FROM products"),
    "dim_date": _clean_sql(_DATE_DIM, select="SELECT * FROM dates"),
    "fact_orders": _clean_sql(
        _CUSTOMERS, _PRODUCTS, _COUNTRY_DIM, _FACT, select="SELECT * FROM fact"
    ),
    "batch_run": _clean_sql(
        _CUSTOMERS, _PRODUCTS, _COUNTRY_DIM, _DATE_DIM, _FACT, select=_STAR_COUNTS
    ),
    "revenue_by_region": _clean_sql(
        select=f"""SELECT {_REGION} AS region, count(*) AS line_count,
  CAST(sum(CAST(total_amount_usd AS DECIMAL(18,2))) AS DOUBLE) AS revenue_usd
FROM cleaned GROUP BY 1"""
    ),
    "null_counts": _raw_sql(_NULL_COUNTS),
    "table_shape": _raw_sql(
        "SELECT count(*) AS row_count, CAST(8 AS BIGINT) AS column_count FROM raw"
    ),
    "preview_orders": _raw_sql(_FIRST_LINES.format(5)),
    "customer_copy": _raw_sql('SELECT *, "Customer ID" AS "CustomerID" FROM raw'),
    "top_countries": _raw_sql(
        'SELECT "Country" AS country, count(*) AS "count" FROM raw '
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"
    ),
    "top_invoices": _raw_sql(
        'SELECT "Invoice" AS invoice, count(*) AS total FROM raw '
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"
    ),
    "dated_rates": _with(
        _RATES,
        select='SELECT CAST(year("date") AS INTEGER) AS "year", monthname("date") AS "month", '
        'CAST(day("date") AS INTEGER) AS "day", gbp_to_usd FROM rates',
    ),
    "event_json": _raw_sql(_RAW_AS_EVENTS),
    "replay_slice": _raw_sql(_FIRST_LINES.format(100)),
    "parse_events": _with(_EVENTS, select=_PARSED),
    "enrich_events": _event_sql(select="SELECT * FROM enriched"),
    "window_metrics": _event_sql(_metrics(), select="SELECT * FROM metrics"),
    "window_top_product": _event_sql(
        _metrics(), select="SELECT window_start, top_product_code FROM metrics"
    ),
    "window_top_country": _event_sql(
        _metrics(), select="SELECT window_start, top_country FROM metrics"
    ),
    "upsert_metrics": _event_sql(
        _enriched(RERATED, "rerated"),
        _metrics(),
        _metrics("rerated", "corrected"),
        select=f"""SELECT * FROM metrics WHERE window_start < TIMESTAMP '{RERATED_FROM}'
UNION ALL
SELECT * FROM corrected WHERE window_start >= TIMESTAMP '{RERATED_FROM}'""",
    ),
    "stream_append_events": _event_sql(select=_APPENDED),
    "stream_window_metrics": _event_sql(_metrics(), select="SELECT * FROM metrics"),
    "stream_closed_windows": _event_sql(
        _metrics(),
        select="SELECT * FROM metrics WHERE window_end "
        "<= (SELECT max(invoice_date) FROM enriched) - INTERVAL 10 MINUTE",
    ),
    "stream_compacted_events": _event_sql(select=_APPENDED),
    "stream_compacted_metrics": _event_sql(_metrics(), select="SELECT * FROM metrics"),
    "stream_piece_metrics": _event_sql(_metrics(), select="SELECT * FROM metrics"),
    "paced_replay": _raw_sql(_REPLAYED),
    "continued_customers": _clean_sql(
        _CUSTOMERS,
        _numbered("customer_id", "customer_key"),
        select="SELECT customers.* EXCLUDE (customer_key), numbered.customer_key "
        "FROM customers JOIN numbered USING (customer_id)",
    ),
    "continued_products": _clean_sql(
        _part("later", ">="),
        _part("earlier", "<"),
        _PRODUCTS.replace("FROM cleaned", "FROM later").replace("products AS", "newer AS"),
        _PRODUCTS.replace("FROM cleaned", "FROM earlier").replace("products AS", "older AS"),
        _numbered("stock_code", "product_key"),
        select="""SELECT p.* EXCLUDE (product_key), numbered.product_key
FROM (SELECT * FROM newer UNION ALL SELECT * FROM older ANTI JOIN newer USING (stock_code)) p
JOIN numbered USING (stock_code)""",
    ),
    "row_accounting": _clean_sql(_ROW_ACCOUNTING, select=_ROW_COUNTS),
    "bucketed_lookup": _clean_sql(
        _CUSTOMERS,
        select="SELECT customer_id, invoice_no, stock_code, quantity, customer_key "
        "FROM cleaned JOIN (SELECT customer_id, customer_key FROM customers) USING (customer_id)",
    ),
    "stream_quarantine": f"""SELECT CASE kind WHEN 0 THEN 'empty' WHEN 4 THEN 'empty'
    WHEN 1 THEN 'not an object' WHEN 3 THEN 'not an object'
    WHEN 2 THEN 'no fields' ELSE 'unreadable field' END AS reason,
  CASE kind WHEN 0 THEN '' WHEN 1 THEN 'order ' || invoice_no
    WHEN 2 THEN '{{"order": "' || invoice_no || '"}}'
    WHEN 3 THEN '{{"invoice_no": "' || invoice_no
    WHEN 4 THEN '' ELSE '{{"invoice_no": "' || invoice_no || '", "quantity": "x"}}'
  END AS value
FROM (SELECT event_id % {DAMAGED_EVERY} AS kind,
             CASE WHEN event_type = 'error' THEN 'C' ELSE '' END
               || CAST(event_id // 2 AS VARCHAR) AS invoice_no FROM events)
WHERE kind < 6""",
    "stream_readable_events": f"WITH {_UNDAMAGED}, {_enriched(EVENT_RATE)}\n{_APPENDED}",
}
