"""DuckDB text of the same results, used as the correctness oracle.

The driver registers the benchmark tables as DuckDB views (``events``,
``lineitem``, ...).  The canonical frame is therefore named ``ev`` here, built
by the DuckDB form of the two adapters in ``eventmart.sources.tables``.
"""

from __future__ import annotations

CLICKSTREAM_EV = """
SELECT user_id AS session_id,
       ts AS event_time,
       CAST(ts AS DATE) AS event_date,
       strftime(ts, '%Y-%m-%d') AS event_date_str,
       CAST(hour(ts) AS INTEGER) AS event_hour,
       strftime(ts, '%Y-%m') AS event_month,
       event_type,
       CAST(event_id % 5 + 1 AS INTEGER) AS page_number,
       'P' || k AS product_id,
       CAST(TRY_CAST(k AS INTEGER) % 5 AS INTEGER) AS category_id,
       CASE TRY_CAST(k AS INTEGER) % 5 WHEN 1 THEN 'Trousers' WHEN 2 THEN 'Skirts'
            WHEN 3 THEN 'Blouses' WHEN 4 THEN 'Sale' ELSE 'Other' END AS category_name,
       CAST(user_id % 30 AS VARCHAR) AS country,
       value AS price
FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k FROM events) s
"""

SALES_EV = """
SELECT l_orderkey AS session_id,
       l_shipdate AS event_time,
       CAST(l_shipdate AS DATE) AS event_date,
       strftime(l_shipdate, '%Y-%m-%d') AS event_date_str,
       CAST(hour(l_shipdate) AS INTEGER) AS event_hour,
       strftime(l_shipdate, '%Y-%m') AS event_month,
       l_returnflag AS event_type,
       l_linenumber AS page_number,
       'P' || CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_partkey % 5 AS INTEGER) AS category_id,
       CASE l_partkey % 5 WHEN 1 THEN 'Trousers' WHEN 2 THEN 'Skirts'
            WHEN 3 THEN 'Blouses' WHEN 4 THEN 'Sale' ELSE 'Other' END AS category_name,
       CAST(l_suppkey % 25 AS VARCHAR) AS country,
       l_extendedprice AS price
FROM lineitem
"""

# What the ETL must produce from the raw files of ``plans.etl_runs``.
ETL_CLICKSTREAM_EV = """
SELECT CAST(user_id AS VARCHAR) AS session_id,
       ts AS event_time,
       CAST(ts AS DATE) AS event_date,
       strftime(ts, '%Y-%m-%d') AS event_date_str,
       CAST(hour(ts) AS INTEGER) AS event_hour,
       strftime(ts, '%Y-%m') AS event_month,
       dayname(ts) AS day_of_week,
       event_type,
       event_id % 5 + 1 AS page_number,
       CAST(TRY_CAST(k AS INTEGER) % 5 AS DOUBLE) AS category_id,
       CASE TRY_CAST(k AS INTEGER) % 5 WHEN 1 THEN 'Trousers' WHEN 2 THEN 'Skirts'
            WHEN 3 THEN 'Blouses' WHEN 4 THEN 'Sale' ELSE 'Other' END AS category_name,
       'P' || k AS product_id,
       CASE WHEN user_id % 30 = 0 THEN 'unknown' ELSE 'C' || CAST(user_id % 30 AS VARCHAR) END AS country,
       CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) ELSE value END AS price,
       props AS extra_col
FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k FROM events) s
"""

ETL_SALES_EV = """
SELECT CAST(l_orderkey AS VARCHAR) AS session_id,
       CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS event_time,
       CAST(l_shipdate AS DATE) AS event_date,
       strftime(l_shipdate, '%Y-%m-%d') AS event_date_str,
       CAST(0 AS INTEGER) AS event_hour,
       strftime(l_shipdate, '%Y-%m') AS event_month,
       dayname(l_shipdate) AS day_of_week,
       CAST(l_linenumber AS BIGINT) AS event_sequence,
       l_returnflag AS event_type,
       CAST(l_partkey % 5 AS DOUBLE) AS category_id,
       CASE l_partkey % 5 WHEN 1 THEN 'Trousers' WHEN 2 THEN 'Skirts'
            WHEN 3 THEN 'Blouses' WHEN 4 THEN 'Sale' ELSE 'Other' END AS category_name,
       'P' || CAST(l_partkey AS VARCHAR) AS product_id,
       l_extendedprice AS price,
       l_tax AS price_secondary,
       'S' || CAST(l_suppkey % 25 AS VARCHAR) AS country,
       CASE WHEN l_linestatus = 'O' THEN 'mobile' ELSE 'unknown' END AS device
FROM lineitem
"""

# The clickstream export after scan, column mapping and typing (one copy of
# each row; the export holds every row twice).
CLICKSTREAM_TYPED_EV = """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
       CAST(user_id AS VARCHAR) AS session_id,
       ' ' || event_type || ' ' AS event_type,
       event_id % 5 + 1 AS page_number,
       CAST(TRY_CAST(k AS INTEGER) % 5 AS DOUBLE) AS category_id,
       'P' || k AS product_id,
       CASE WHEN user_id % 30 = 0 THEN NULL ELSE 'C' || CAST(user_id % 30 AS VARCHAR) END AS country,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS price,
       props AS extra_col
FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k FROM events) s
"""

EV = {"clickstream": CLICKSTREAM_EV, "sales": SALES_EV,
      "clickstream_typed": CLICKSTREAM_TYPED_EV,
      "etl_clickstream": ETL_CLICKSTREAM_EV, "etl_sales": ETL_SALES_EV}


def with_ev(adapter: str, body: str) -> str:
    """``body`` reads ``ev``; prepend the adapter as a CTE."""
    return f"WITH ev AS ({EV[adapter].strip()})\n{body.strip()}"
