"""The registered queries in standard SQL, for a check by another engine on the same tables."""

from __future__ import annotations

from tillstream.plans.queries import (
    ADMITTED_FILES,
    AS_OF,
    EVENTS_AS_OF,
    FILES_PER_BATCH,
    FIRST_LOAD,
    HOURS,
    INGESTED_AT,
    PIECES,
    RANGE,
    SENT_FIRST,
)

# Building blocks, named as in sources/tables.py.

_LINES = """
lines AS (
    SELECT l_orderkey || '-' || l_linenumber AS order_id,
           l_orderkey, l_suppkey, l_extendedprice, l_quantity,
           CAST(l_partkey AS VARCHAR) AS product_id,
           CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
           CAST(l_quantity AS INTEGER) AS quantity,
           l_shipdate AS ingestion_timestamp
    FROM lineitem
)"""


def _unique(direction: str) -> str:
    ties = ("ingestion_timestamp", "product_id", "l_suppkey", "l_extendedprice", "l_quantity")
    ordering = ", ".join(f"{name} {direction}" for name in ties)
    return f"""{_LINES},
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {ordering}) AS nth FROM lines
),
unique_lines AS (SELECT * FROM ranked WHERE nth = 1)"""


_JOINED = """
    SELECT l.order_id, CAST(o.o_custkey AS VARCHAR) AS customer_id, l.product_id,
           p.p_name AS product_name, p.p_type AS category, l.price, l.quantity,
           CAST(l.price * l.quantity AS DECIMAL(12,2)) AS revenue,
           o.o_orderdate AS order_ts, CAST(o.o_orderdate AS DATE) AS order_date,
           n.n_name AS country, l.ingestion_timestamp
    FROM {lines} l
    JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN part p ON CAST(p.p_partkey AS VARCHAR) = l.product_id
    JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey"""

_SILVER = f"WITH {_unique('DESC')},\nsales AS ({_JOINED.format(lines='unique_lines')}\n)"
_BRONZE = f"WITH {_LINES},\nsales AS ({_JOINED.format(lines='lines')}\n)"
_PRODUCT_SALES = f"""WITH {_unique('DESC')},
sales AS (
    SELECT l.order_id, l.product_id, p.p_name AS product_name, p.p_type AS category,
           CAST(l.price * l.quantity AS DECIMAL(12,2)) AS revenue
    FROM unique_lines l JOIN part p ON CAST(p.p_partkey AS VARCHAR) = l.product_id
)"""
_FIRST = f"WITH {_unique('ASC')}"

_MESSAGES = """
WITH counted AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
stamped AS (
    SELECT *, CASE WHEN k % 10 = 9 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                   ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp
    FROM counted
),
texts AS (
    SELECT *, '{"order_id":"' || event_id || '","customer_id":'
           || CASE WHEN event_type = 'error' THEN 'null' ELSE '"' || user_id || '"' END
           || ',"product_id":"' || k || '","product_name":"' || event_type
           || '","category":"' || event_type || '","price":' || value
           || ',"quantity":' || (k % 7) || ',"order_timestamp":"'
           || stamp || '"}' AS full_text
    FROM stamped
),
decoded AS (
    SELECT CASE WHEN k = 42 THEN 'order ' ELSE '' END || full_text AS raw_value,
           k = 42 AS malformed,
           CASE WHEN k <> 42 THEN CAST(event_id AS VARCHAR) END AS order_id,
           CASE WHEN k <> 42 AND event_type <> 'error'
                THEN CAST(user_id AS VARCHAR) END AS customer_id,
           CASE WHEN k <> 42 THEN CAST(k AS VARCHAR) END AS product_id,
           CASE WHEN k <> 42 THEN event_type END AS product_name,
           CASE WHEN k <> 42 THEN event_type END AS category,
           CASE WHEN k <> 42 THEN value END AS price,
           CASE WHEN k <> 42 THEN CAST(k % 7 AS INTEGER) END AS quantity,
           CASE WHEN k <> 42 THEN stamp END AS order_timestamp,
           CASE WHEN k <> 42 AND k % 10 <> 9 THEN date_trunc('second', ts) END AS order_ts
    FROM texts
),
flagged AS (
    SELECT *, coalesce(order_id IS NOT NULL AND customer_id IS NOT NULL AND price > 0
                       AND quantity > 0, FALSE) AS valid
    FROM decoded
)"""

_BRONZE_VIEW = f"""{_MESSAGES}
SELECT order_id, customer_id, product_id, category, price, quantity, order_ts,
       CAST(year(order_ts) AS INTEGER) AS year, CAST(month(order_ts) AS INTEGER) AS month,
       CAST(day(order_ts) AS INTEGER) AS day
FROM flagged WHERE valid AND order_ts IS NOT NULL"""


def _rejects(strict: bool) -> str:
    product = (
        "CASE WHEN product_id IS NULL THEN 'missing_product_id' END," if strict else ""
    )
    stamp = (
        "CASE WHEN order_timestamp IS NULL THEN 'missing_order_timestamp' END," if strict else ""
    )
    # Reasons in alphabetical order.
    return f"""{_MESSAGES}
SELECT raw_value, order_id, concat_ws(',',
           CASE WHEN order_ts IS NULL THEN 'bad_order_timestamp' END,
           CASE WHEN malformed THEN 'malformed_json' END,
           CASE WHEN customer_id IS NULL THEN 'missing_customer_id' END,
           CASE WHEN order_id IS NULL THEN 'missing_order_id' END,
           {stamp}
           {product}
           CASE WHEN price IS NULL OR price <= 0 THEN 'price_not_positive' END,
           CASE WHEN quantity IS NULL OR quantity <= 0 THEN 'quantity_not_positive' END
       ) AS reasons
FROM flagged WHERE NOT (valid AND order_ts IS NOT NULL)"""


_HOURLY = """
SELECT date_trunc('hour', ts) AS window_start, event_type AS category,
       CAST(sum(CAST(value AS DECIMAL(10,2))) AS DOUBLE) AS total_revenue,
       count(*) AS order_count,
       CAST(sum(CAST(value AS DECIMAL(10,2))) AS DOUBLE) / count(*) AS avg_order_value
FROM events GROUP BY 1, 2"""


def _check(check: str, column: str, value: str, threshold: float) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", "
        f"CAST({value} AS DOUBLE) AS value, CAST({threshold} AS DOUBLE) AS threshold, "
        f"CAST({value} AS DOUBLE) <= {threshold} AS passed"
    )


def _checks(*checks: str, source: str) -> str:
    return "\nUNION ALL\n".join(f"{check} FROM {source}" for check in checks)


def _drift(before: str, after: str) -> str:
    return f"CAST({before} - {after} AS DOUBLE) / {before} * 100"


def _share(count: str) -> str:
    return f"CAST({count} AS DOUBLE) / count(*) * 100"


def _age(as_of: str, column: str) -> str:
    passed = f"epoch_us(TIMESTAMP '{as_of}') - epoch_us(max({column}))"
    return f"CAST({passed} AS DOUBLE) / 3600000000"


# Prices that are no amounts, as in queries.py.
_ODD_PRICES = """
WITH odd AS (
    SELECT event_id, CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
           CASE WHEN event_id % 97 = 0 THEN CAST('NaN' AS DOUBLE)
                WHEN event_id % 89 = 0 THEN CAST('Infinity' AS DOUBLE)
                WHEN event_id % 83 = 0 THEN 1e9 ELSE value END AS price, ts
    FROM events
)"""

_CRITICAL = ("order_id", "customer_id", "product_id", "price", "quantity", "order_timestamp")

_COPIES = f"""WITH {_LINES},
per_key AS (SELECT order_id, count(*) AS copies FROM lines GROUP BY order_id)"""

_LATEST_CUSTOMER = """
latest AS (SELECT customer_id, arg_max(country, (order_ts, order_id)) AS country
           FROM sales GROUP BY customer_id)"""

# Of orders sent again the last one sent counts, of those sent by then.
def _resent(before: int = 1_000_003) -> str:
    return f"""{_ODD_PRICES},
latest AS (SELECT customer_id || '-' || event_id % 5 AS order_id,
                  arg_max(struct_pack(p := price, t := date_trunc('second', ts), c := event_type,
                                      customer := customer_id),
                          event_id * 7919 % 1000003) AS v
           FROM odd JOIN (SELECT event_id, event_type FROM events) USING (event_id)
           WHERE isfinite(price) AND price > 0 AND customer_id IS NOT NULL
             AND event_id * 7919 % 1000003 < {before}
           GROUP BY 1),
silver AS (SELECT order_id, v.customer AS customer_id, v.p AS price, v.c AS category, v.t AS order_ts,
                  CAST(v.t AS DATE) AS order_date, CAST(v.p AS DECIMAL(38,2)) AS revenue FROM latest)"""


def _resent_gold(number: int, before: int) -> str:
    return f"""SELECT * FROM ({_resent(before)}
SELECT category, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(*) AS order_count,
       {number} AS release
FROM silver GROUP BY category)"""


# Orders that come once, and those that come again long after; copies that come soon are left out.
_SENT_AGAIN = """
SELECT CAST(event_id AS VARCHAR) AS order_id, FALSE AS again FROM events
UNION ALL
SELECT CAST(event_id AS VARCHAR), TRUE FROM events
WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 = 0"""

_ORACLE: dict[str, str] = {
    "dedup_latest": f"""{_SILVER}
SELECT order_id, customer_id, product_id, CAST(price AS DOUBLE) AS price, quantity,
       CAST(revenue AS DOUBLE) AS revenue, order_date, ingestion_timestamp
FROM sales""",
    "dedup_first": f"""{_FIRST}
SELECT order_id, product_id, CAST(price AS DOUBLE) AS price, quantity, ingestion_timestamp
FROM unique_lines""",
    "positive_after_dedup": f"""WITH {_unique('DESC')}
SELECT order_id, CAST(price - 1000 * quantity AS DOUBLE) AS margin, quantity
FROM unique_lines WHERE price - 1000 * quantity > 0 AND quantity > 0""",
    "daily_revenue": f"""{_SILVER}
SELECT order_date, CAST(sum(revenue) AS DOUBLE) AS total_daily_revenue,
       count(order_id) AS total_orders
FROM sales GROUP BY order_date""",
    "category_metrics": f"""{_PRODUCT_SALES}
SELECT category, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(order_id) AS order_count
FROM sales GROUP BY category""",
    "top_products": f"""{_PRODUCT_SALES}
SELECT product_id, product_name, CAST(sum(revenue) AS DOUBLE) AS total_revenue
FROM sales GROUP BY product_id, product_name
ORDER BY sum(revenue) DESC, product_id, product_name LIMIT 10""",
    "hourly_metrics": _HOURLY,
    "dim_product": f"""{_SILVER},
latest AS (SELECT product_id, arg_max(product_name, (order_ts, order_id)) AS product_name,
                  arg_max(category, (order_ts, order_id)) AS category
           FROM sales GROUP BY product_id)
SELECT CAST(row_number() OVER (ORDER BY md5(product_id), product_id) AS INTEGER) AS product_key,
       product_id, product_name, category
FROM latest""",
    "dim_customer": f"""{_SILVER},{_LATEST_CUSTOMER}
SELECT CAST(row_number() OVER (ORDER BY md5(customer_id), customer_id) AS INTEGER)
       AS customer_key, customer_id, country
FROM latest""",
    "dim_customer_refresh": f"""{_SILVER},{_LATEST_CUSTOMER},
known AS (SELECT DISTINCT customer_id, TRUE AS loaded FROM sales
          WHERE order_date < DATE '{FIRST_LOAD}')
SELECT CAST(row_number() OVER (ORDER BY coalesce(loaded, FALSE) DESC, md5(customer_id),
                               customer_id) AS INTEGER) AS customer_key, customer_id, country
FROM latest LEFT JOIN known USING (customer_id)""",
    "dim_supplier": f"""WITH {_LINES},
latest AS (SELECT product_id,
                  max(struct_pack(seen := o.o_orderdate, s := CAST(l_suppkey AS VARCHAR),
                                  p := CAST(price AS VARCHAR))) AS v
           FROM lines l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY product_id)
SELECT CAST(row_number() OVER (ORDER BY md5(product_id), product_id) AS INTEGER) AS product_key,
       product_id, v.s AS product_name, v.p AS category
FROM latest""",
    "fact_by_time": f"""{_SILVER}
SELECT order_date, count(*) AS orders, 0 AS out_of_order FROM sales GROUP BY order_date""",
    "fact_by_customer": f"""{_SILVER}
SELECT customer_id, CAST(sum(revenue) AS DOUBLE) AS revenue FROM sales GROUP BY customer_id""",
    "colocated_countries": f"""{_SILVER}
SELECT country, CAST(date_trunc('month', order_date) AS DATE) AS sales_month,
       CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       count(DISTINCT customer_id) AS unique_customers
FROM sales GROUP BY 1, 2""",
    "monthly_customers": f"""{_SILVER}
SELECT country, CAST(date_trunc('month', order_date) AS DATE) AS sales_month,
       count(DISTINCT customer_id) AS unique_customers
FROM sales GROUP BY 1, 2""",
    "fact_hours": f"""{_ODD_PRICES}
SELECT order_id, customer_id, event_type AS product_id, CAST(price AS DECIMAL(10,2))::DOUBLE AS price,
       1 AS quantity, CAST(price AS DECIMAL(12,2))::DOUBLE AS revenue,
       date_trunc('second', ts) AS order_ts, CAST(ts AS DATE) AS order_date
FROM odd JOIN (SELECT event_id, event_type FROM events) USING (event_id)
WHERE isfinite(price) AND price < 1e8 AND customer_id IS NOT NULL
  AND date_trunc('second', ts) >= TIMESTAMP '{HOURS[0]}' AND date_trunc('second', ts) < TIMESTAMP '{HOURS[1]}'""",
    "amount_rejects": f"""{_ODD_PRICES},
refused AS (SELECT *, concat_ws(',',
                CASE WHEN coalesce(customer_id, '') = '' THEN 'missing_customer_id' END,
                CASE WHEN NOT price > 0 THEN 'price_not_positive' END,
                CASE WHEN NOT isfinite(price) THEN 'price_not_finite' END) AS reasons
            FROM odd),
judged AS (SELECT CASE WHEN reasons <> '' THEN reasons
                       WHEN price >= 1e8 THEN 'price_out_of_range' ELSE 'loaded' END AS outcome
           FROM refused)
SELECT outcome, count(*) AS orders FROM judged GROUP BY outcome
UNION ALL SELECT 'gold', count(*) FROM judged WHERE outcome IN ('loaded', 'price_out_of_range')
UNION ALL SELECT 'reject_check', count(*) FROM judged WHERE outcome = 'price_out_of_range'""",
    "dim_date": """
WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS first_day,
                     CAST(max(o_orderdate) AS DATE) AS last_day FROM orders),
days AS (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE)
                AS full_date FROM span)
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
       CAST(day(full_date) AS INTEGER) AS day, CAST(month(full_date) AS INTEGER) AS month,
       CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
       dayofweek(full_date) IN (0, 6) AS is_weekend
FROM days""",
    "fact_constraints": f"""{_COPIES},
counts AS (SELECT
    (SELECT count(*) FROM per_key WHERE copies > 1) AS duplicated,
    (SELECT count(*) FROM lines WHERE order_id IS NULL) AS no_order,
    (SELECT count(*) FROM orders WHERE o_custkey IS NULL) AS no_customer,
    (SELECT count(*) FROM lines WHERE product_id IS NULL) AS no_product,
    (SELECT count(*) FROM lines WHERE length(order_id) > 50) AS long_order,
    (SELECT count(*) FROM orders WHERE length(CAST(o_custkey AS VARCHAR)) > 50) AS long_customer,
    (SELECT count(*) FROM lines WHERE length(product_id) > 50) AS long_product)
{_checks(
    _check('primary_key', 'order_id', 'duplicated', 0),
    _check('not_null', 'order_id', 'no_order', 0),
    _check('not_null', 'customer_id', 'no_customer', 0),
    _check('not_null', 'product_id', 'no_product', 0),
    _check('text_length', 'order_id', 'long_order', 0),
    _check('text_length', 'customer_id', 'long_customer', 0),
    _check('text_length', 'product_id', 'long_product', 0),
    source='counts')}""",
    "daily_trend": f"""{_SILVER}
SELECT order_date, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       count(DISTINCT order_id) AS total_orders,
       CAST(sum(quantity) AS BIGINT) AS total_items_sold
FROM sales GROUP BY order_date""",
    "daily_trend_distinct": f"""{_BRONZE}
SELECT order_date, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       count(DISTINCT order_id) AS total_orders,
       CAST(sum(quantity) AS BIGINT) AS total_items_sold
FROM sales GROUP BY order_date""",
    "top_categories": f"""{_SILVER}
SELECT category, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       count(DISTINCT order_id) AS order_count
FROM sales GROUP BY category ORDER BY sum(revenue) DESC, category LIMIT 10""",
    "top_categories_distinct": f"""{_BRONZE}
SELECT category, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       count(DISTINCT order_id) AS order_count
FROM sales GROUP BY category ORDER BY sum(revenue) DESC, category LIMIT 10""",
    "country_distribution": f"""{_SILVER}
SELECT country, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       count(DISTINCT customer_id) AS unique_customers
FROM sales GROUP BY country""",
    "monthly_revenue": f"""{_SILVER}
SELECT CAST(date_trunc('month', order_date) AS DATE) AS sales_month,
       CAST(sum(revenue) AS DOUBLE) AS revenue
FROM sales GROUP BY 1""",
    "mom_growth": f"""{_SILVER},
months AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS sales_month,
                  sum(revenue) AS revenue FROM sales GROUP BY 1),
paired AS (SELECT *, lag(revenue) OVER (ORDER BY sales_month) AS previous FROM months)
SELECT sales_month, CAST(revenue AS DOUBLE) AS revenue,
       CAST(previous AS DOUBLE) AS prev_month_revenue,
       CAST(round((revenue - previous) / nullif(previous, 0) * 100, 2) AS DOUBLE)
       AS growth_percentage
FROM paired""",
    "ingest_stamp": f"""{_MESSAGES}
SELECT order_id, TIMESTAMP '{INGESTED_AT}' AS ingestion_timestamp, order_timestamp, order_ts
FROM flagged WHERE valid AND order_ts IS NOT NULL""",
    "sql_views": f"""{_SILVER}
SELECT country, CAST(date_trunc('month', order_date) AS DATE) AS sales_month,
       CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       count(DISTINCT customer_id) AS unique_customers
FROM sales GROUP BY 1, 2""",
    "row_count_drift": f"""{_COPIES},
counts AS (SELECT sum(copies) AS before, count(*) AS after FROM per_key)
{_checks(_check('count_check', 'bronze to silver', _drift('before', 'after'), 5.0),
         source='counts')}""",
    "null_profile": f"""{_MESSAGES}
{_checks(*[_check('null_check', name, _share(f'count(*) FILTER (WHERE {name} IS NULL)'), 1.0)
           for name in _CRITICAL], source='decoded')}""",
    "positive_profile": f"""{_MESSAGES}
{_checks(*[_check('positive_check', name, f'count(*) FILTER (WHERE {name} <= 0)', 0.0)
           for name in ('price', 'quantity')], source='decoded')}""",
    "freshness": _checks(
        _check(
            "freshness_check",
            "order_ts",
            _age(AS_OF, "o_orderdate"),
            24.0,
        ),
        source="orders",
    ),
    "duplicate_orders": f"""{_COPIES}
SELECT order_id, copies FROM per_key WHERE copies > 1""",
    "duplicate_check": f"""{_COPIES}
{_checks(_check('dup_check', 'order_id', 'count(*) FILTER (WHERE copies > 1)', 0.0),
         source='per_key')}""",
    "duplicate_ratio": f"""{_COPIES},
counts AS (SELECT sum(copies) AS before, count(*) AS after FROM per_key)
{_checks(_check('duplicate_ratio_check', 'order_id', _drift('before', 'after'), 0.1),
         source='counts')}""",
    "quality_report": f"""{_SILVER},
per_key AS (SELECT order_id, count(*) AS copies FROM lines GROUP BY order_id),
silver AS (SELECT u.order_id, o.o_custkey AS customer_id, u.price * u.quantity AS revenue
           FROM unique_lines u JOIN orders o ON o.o_orderkey = u.l_orderkey),
silver_keys AS (SELECT order_id, count(*) AS copies FROM silver GROUP BY order_id),
counts AS (SELECT
    (SELECT sum(copies) FROM per_key) AS before,
    (SELECT count(*) FROM per_key) AS after,
    (SELECT count(*) FROM silver) AS silver_rows,
    (SELECT count(*) FROM silver_keys) AS silver_keys,
    (SELECT count(*) FROM silver WHERE order_id IS NULL) AS no_order,
    (SELECT count(*) FROM silver WHERE customer_id IS NULL) AS no_customer,
    (SELECT count(*) FROM silver WHERE revenue IS NULL) AS no_revenue,
    (SELECT count(*) FROM silver_keys WHERE copies > 1) AS duplicated)
{_checks(
    _check('count_check', 'bronze to silver', _drift('before', 'silver_rows'), 5.0),
    _check('key_check', 'order_id', _drift('after', 'silver_keys'), 5.0),
    _check('null_check', 'order_id', 'CAST(no_order AS DOUBLE) / silver_rows * 100', 0.0),
    _check('null_check', 'customer_id', 'CAST(no_customer AS DOUBLE) / silver_rows * 100', 0.0),
    _check('null_check', 'revenue', 'CAST(no_revenue AS DOUBLE) / silver_rows * 100', 0.0),
    _check('dup_check', 'order_id', 'duplicated', 0.0),
    source='counts')}""",
    "threshold_report": f"""{_MESSAGES},
per_key AS (SELECT order_id, count(*) AS copies FROM decoded GROUP BY order_id),
counts AS (SELECT sum(copies) AS before, count(*) AS after FROM per_key)
{_checks(
    *[_check('null_check', name, _share(f'count(*) FILTER (WHERE {name} IS NULL)'), 1.0)
      for name in _CRITICAL],
    *[_check('positive_check', name, f'count(*) FILTER (WHERE {name} <= 0)', 0.0)
      for name in ('price', 'quantity')],
    _check('freshness_check', 'order_ts', _age(EVENTS_AS_OF, 'order_ts'), 24.0),
    source='decoded')}
UNION ALL
{_checks(_check('duplicate_ratio_check', 'order_id', _drift('before', 'after'), 0.1),
         source='counts')}""",
    "decode_messages": f"""{_MESSAGES}
SELECT order_id, customer_id, product_id, product_name, category, price, quantity,
       order_timestamp, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS event_time,
       CAST(NULL AS VARCHAR) AS event_source, raw_value, malformed
FROM decoded""",
    "decode_props": """
SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n
FROM events GROUP BY 1""",
    "encode_messages": f"""WITH {_unique('DESC')}
SELECT order_id AS key, '{{"order_id":"' || order_id || '","country":null,"product_id":"'
       || product_id || '","price":' || price || ',"quantity":' || quantity || '}}' AS value
FROM unique_lines""",
    "event_defaults": """
SELECT event_id, CASE WHEN event_type IN ('view', 'error') THEN '2024-02-01T00:00:00.000000Z'
                      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS event_time,
       'kafka_producer' AS event_source
FROM events""",
    "typed_strings": """
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS price,
       CASE WHEN event_type <> 'view'
            THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS quantity
FROM events""",
    "csv_orders": f"""{_SILVER}
SELECT order_id, customer_id, product_id, product_name, category,
       CAST(price AS DOUBLE) AS price, quantity,
       strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_timestamp, country
FROM sales""",
    "bronze_columns": _BRONZE_VIEW,
    "loosely_accepted": f"""{_MESSAGES}
SELECT order_id, customer_id, price, quantity, order_timestamp FROM flagged WHERE valid""",
    "rejected_events": _rejects(strict=False),
    "strictly_rejected": _rejects(strict=True),
    "bronze_table": _BRONZE_VIEW,
    "stream_bronze": _BRONZE_VIEW,
    "stream_dead_letters": _rejects(strict=False),
    # A window is written once the newest event is an hour past its end.
    "stream_closed_windows": f"""
SELECT * FROM ({_HOURLY})
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "stream_open_windows": _HOURLY,
    "stream_late_events": """
SELECT event_type AS category, count(*) AS orders, TRUE AS some_late FROM events GROUP BY 1""",
    "bronze_of_both_jobs": _BRONZE_VIEW,
    "layered_daily": f"""{_MESSAGES}
SELECT CAST(order_ts AS DATE) AS order_date,
       CAST(sum(CAST(price AS DECIMAL(10,2)) * quantity) AS DOUBLE) AS total_daily_revenue,
       count(order_id) AS total_orders
FROM flagged WHERE valid AND order_ts IS NOT NULL GROUP BY 1""",
    "layered_range": f"""{_ODD_PRICES},
latest AS (SELECT customer_id || '-' || event_id % 5 AS order_id,
                  arg_max(struct_pack(p := price, d := CAST(ts AS DATE)),
                          event_id * 7919 % 1000003) AS v
           FROM odd WHERE isfinite(price) AND price > 0 AND customer_id IS NOT NULL
           GROUP BY 1)
SELECT order_id, v.d AS order_date, v.p AS price FROM latest
WHERE v.d BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'""",
    "stream_dedup": f"WITH {_LINES}\nSELECT DISTINCT order_id FROM lines",
    "incremental_silver": f"""{_resent()}
SELECT order_id, order_date, price FROM silver""",
    "incremental_daily": f"""{_resent()}
SELECT order_date, CAST(sum(revenue) AS DOUBLE) AS total_daily_revenue, count(*) AS total_orders
FROM silver GROUP BY order_date""",
    "incremental_gold": f"""{_resent()}
SELECT category, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(*) AS order_count
FROM silver GROUP BY category""",
    "released_gold": f"""{_resent_gold(1, SENT_FIRST)}
UNION ALL
{_resent_gold(2, 1_000_003)}""",
    "fact_merge": f"""{_resent()}
SELECT order_id, customer_id, CAST(price AS DECIMAL(10,2))::DOUBLE AS price, 1 AS quantity,
       revenue::DOUBLE AS revenue, order_ts, order_date
FROM silver WHERE price < 1e8""",
    "stream_state_windows": _HOURLY,
    "stream_state_dedup": _SENT_AGAIN,
    "stream_unique_within": f"""
SELECT * FROM ({_SENT_AGAIN}), (SELECT unnest([1, {PIECES}]) AS batches)""",
    "stream_restart": _BRONZE_VIEW,
    "stream_admission": f"""
WITH files AS (SELECT count(*) AS n, ceil(count(*) / {ADMITTED_FILES}) AS most FROM events)
SELECT CAST(ceil(ceil(n / most) / {FILES_PER_BATCH}) AS BIGINT) AS batches,
       CAST(least(n, most * {FILES_PER_BATCH}) AS BIGINT) AS largest, TRUE AS within_limit, n AS rows
FROM files""",
    "layered_gold": f"""{_MESSAGES}
SELECT category,
       CAST(sum(CAST(price AS DECIMAL(10,2)) * quantity) AS DOUBLE) AS total_revenue,
       count(order_id) AS order_count
FROM flagged WHERE valid AND order_ts IS NOT NULL GROUP BY category""",
}

_FACT = f"""{_SILVER}
SELECT order_id, customer_id, product_id, CAST(price AS DOUBLE) AS price, quantity,
       CAST(revenue AS DOUBLE) AS revenue, order_ts, order_date
FROM sales"""

_ASKED = ("daily_trend", "top_categories", "country_distribution", "mom_growth")

ORACLE = {
    **_ORACLE,
    "fact_sales": _FACT,
    "fact_load": _FACT,
    **{f"asked_{name}": _ORACLE[name] for name in _ASKED},
}
