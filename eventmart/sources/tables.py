"""Canonical ``events`` frames derived from the benchmark tables.

The warehouse works on one canonical event schema (``session_id, event_time,
event_date, event_date_str, event_hour, event_month, event_type, page_number,
product_id, category_id, category_name, country, price``).  Two adapters map
the benchmark tables onto it:

* ``clickstream_events`` – from ``events`` (a timestamp per event);
* ``sales_events``       – from ``lineitem`` (midnight timestamps, 83 months).

Both are pure projections over a parquet scan, written as SQL: Catalyst prunes
the scan to the columns a query touches and pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmart.functions.expressions import category_label_sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table as a frame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _time_columns(ts: str) -> str:
    # Day and month text come from the date by plain casts: no time zone is
    # involved (formatting a zone-less timestamp would convert it per row).
    return f"""
       CAST({ts} AS TIMESTAMP_NTZ)                                   AS event_time,
       to_date(CAST({ts} AS TIMESTAMP_NTZ))                          AS event_date,
       CAST(to_date(CAST({ts} AS TIMESTAMP_NTZ)) AS STRING)          AS event_date_str,
       CAST(hour(CAST({ts} AS TIMESTAMP_NTZ)) AS INT)                AS event_hour,
       substring(CAST(to_date(CAST({ts} AS TIMESTAMP_NTZ)) AS STRING), 1, 7) AS event_month"""


# Each adapter is one SQL statement: a single parse on the driver instead of
# hundreds of expression-builder calls, and the same plan either way.
CLICKSTREAM_SQL = f"""
SELECT user_id                                    AS session_id,{_time_columns("ts")},
       event_type,
       CAST(event_id % 5 + 1 AS INT)              AS page_number,
       concat('P', k)                             AS product_id,
       CAST(try_cast(k AS INT) % 5 AS INT)        AS category_id,
       {category_label_sql("CAST(try_cast(k AS INT) % 5 AS INT)")} AS category_name,
       CAST(user_id % 30 AS STRING)               AS country,
       value                                      AS price
FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k FROM {{src}}) s
"""

SALES_SQL = f"""
SELECT l_orderkey                                 AS session_id,{_time_columns("l_shipdate")},
       l_returnflag                               AS event_type,
       l_linenumber                               AS page_number,
       concat('P', CAST(l_partkey AS STRING))     AS product_id,
       CAST(l_partkey % 5 AS INT)                 AS category_id,
       {category_label_sql("CAST(l_partkey % 5 AS INT)")} AS category_name,
       CAST(l_suppkey % 25 AS STRING)             AS country,
       l_extendedprice                            AS price
FROM {{src}}
"""


def clickstream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CLICKSTREAM_SQL, src=table(spark, sf_dir, "events"))


def sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SALES_SQL, src=table(spark, sf_dir, "lineitem"))


ADAPTERS = {"clickstream": clickstream_events, "sales": sales_events}
