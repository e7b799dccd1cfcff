"""The nine named analytics queries, as Spark SQL text.

Each query reads ``{events}``; ``run_query`` binds it to a DataFrame through
``spark.sql(text, events=df)``, so no session-wide view name is shared between
callers.  Every query is a hash aggregate: Spark plans a partial (map-side)
aggregate, one exchange on the group key and a final aggregate; the one
``COUNT(DISTINCT session_id)`` per query is planned with a first exchange on
(key, session_id), so a hot key is spread over many tasks.

Sort keys always end with the group key, so ties (and the top-k cut) are
deterministic.  Money is rounded with ``round2`` semantics: ``ROUND(x*100)/100``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NamedQuery:
    name: str
    sql: str
    requires: frozenset  # canonical columns the query reads
    plain: str | None = None  # the direct form, when ``sql`` is a rewrite of it

    def missing(self, columns) -> list[str]:
        return sorted(self.requires - set(columns))

    @property
    def plain_sql(self) -> str:
        return self.plain or self.sql


def _q(name, requires, sql, plain=None):
    return NamedQuery(name, sql.strip(), frozenset(requires), plain.strip() if plain else None)


QUERIES: dict[str, NamedQuery] = {q.name: q for q in [
    _q("total_events_by_day", {"event_date_str"}, """
SELECT event_date_str AS event_date,
       COUNT(*)       AS total_events
FROM {events}
GROUP BY event_date_str
ORDER BY event_date_str NULLS LAST
"""),
    # (day, session) pairs are the big shuffle: keyed by the date, four bytes, and written as text afterwards
    _q("daily_active_users", {"event_date_str", "event_date", "session_id"}, """
SELECT CAST(day AS STRING) AS event_date,
       active_users
FROM (
    SELECT event_date AS day, COUNT(DISTINCT session_id) AS active_users
    FROM {events}
    GROUP BY event_date
) per_day
ORDER BY event_date NULLS LAST
""", plain="""
SELECT event_date_str             AS event_date,
       COUNT(DISTINCT session_id) AS active_users
FROM {events}
GROUP BY event_date_str
ORDER BY event_date_str NULLS LAST
"""),
    _q("top_event_types", {"page_number", "session_id"}, """
SELECT page_number                AS page_position,
       COUNT(*)                   AS total_events,
       COUNT(DISTINCT session_id) AS unique_sessions
FROM {events}
GROUP BY page_number
ORDER BY total_events DESC, page_position NULLS LAST
"""),
    # The order does not depend on the distinct count, so the top 25 groups are
    # picked from a plain aggregate, and sessions are counted only for them,
    # instead of shuffling every (product, category, session) triple.
    _q("top_products", {"product_id", "category_name", "price", "session_id"}, """
WITH top AS (
    SELECT product_id,
           category_name,
           COUNT(*)                       AS view_count,
           ROUND(AVG(price) * 100) / 100  AS avg_price,
           ROUND(SUM(price) * 100) / 100  AS total_revenue
    FROM {events}
    GROUP BY product_id, category_name
    ORDER BY view_count DESC, product_id NULLS LAST, category_name NULLS LAST
    LIMIT 25
), counted AS (
    SELECT e.product_id, e.category_name, COUNT(DISTINCT e.session_id) AS unique_sessions
    FROM {events} e
    LEFT SEMI JOIN top t
      ON e.product_id IS NOT DISTINCT FROM t.product_id
     AND e.category_name IS NOT DISTINCT FROM t.category_name
    GROUP BY e.product_id, e.category_name
)
SELECT t.product_id,
       t.category_name,
       t.view_count,
       c.unique_sessions,
       t.avg_price,
       t.total_revenue
FROM top t
JOIN counted c
  ON c.product_id IS NOT DISTINCT FROM t.product_id
 AND c.category_name IS NOT DISTINCT FROM t.category_name
ORDER BY view_count DESC, product_id NULLS LAST, category_name NULLS LAST
""", plain="""
SELECT product_id,
       category_name,
       COUNT(*)                       AS view_count,
       COUNT(DISTINCT session_id)     AS unique_sessions,
       ROUND(AVG(price) * 100) / 100  AS avg_price,
       ROUND(SUM(price) * 100) / 100  AS total_revenue
FROM {events}
GROUP BY product_id, category_name
ORDER BY view_count DESC, product_id NULLS LAST, category_name NULLS LAST
LIMIT 25
"""),
    _q("revenue_by_category", {"category_name", "price", "session_id"}, """
SELECT category_name,
       COUNT(*)                       AS total_events,
       COUNT(DISTINCT session_id)     AS unique_sessions,
       ROUND(SUM(price) * 100) / 100  AS total_revenue,
       ROUND(AVG(price) * 100) / 100  AS avg_price,
       ROUND(MIN(price) * 100) / 100  AS min_price,
       ROUND(MAX(price) * 100) / 100  AS max_price
FROM {events}
GROUP BY category_name
ORDER BY total_revenue DESC, category_name NULLS LAST
"""),
    _q("country_device_breakdown", {"country", "price", "session_id"}, """
SELECT country,
       COUNT(*)                       AS total_events,
       COUNT(DISTINCT session_id)     AS unique_sessions,
       ROUND(AVG(price) * 100) / 100  AS avg_price,
       ROUND(SUM(price) * 100) / 100  AS total_revenue
FROM {events}
GROUP BY country
ORDER BY total_events DESC, country NULLS LAST
"""),
    _q("hourly_traffic", {"event_hour", "session_id"}, """
SELECT event_hour,
       COUNT(*)                   AS total_events,
       COUNT(DISTINCT session_id) AS unique_sessions
FROM {events}
WHERE event_hour IS NOT NULL
GROUP BY event_hour
ORDER BY event_hour
"""),
    # likewise keyed by the first day of the month
    _q("monthly_trends", {"event_month", "event_date", "price", "session_id"}, """
SELECT SUBSTRING(CAST(month AS STRING), 1, 7) AS event_month,
       total_events,
       unique_sessions,
       total_revenue
FROM (
    SELECT TRUNC(event_date, 'MM')        AS month,
           COUNT(*)                       AS total_events,
           COUNT(DISTINCT session_id)     AS unique_sessions,
           ROUND(SUM(price) * 100) / 100  AS total_revenue
    FROM {events}
    WHERE event_date IS NOT NULL
    GROUP BY TRUNC(event_date, 'MM')
) per_month
ORDER BY event_month
""", plain="""
SELECT event_month,
       COUNT(*)                       AS total_events,
       COUNT(DISTINCT session_id)     AS unique_sessions,
       ROUND(SUM(price) * 100) / 100  AS total_revenue
FROM {events}
WHERE event_month IS NOT NULL
GROUP BY event_month
ORDER BY event_month
"""),
    _q("session_depth", {"session_id"}, """
SELECT pages_per_session,
       COUNT(*) AS session_count
FROM (
    SELECT session_id, COUNT(*) AS pages_per_session
    FROM {events}
    GROUP BY session_id
) per_session
GROUP BY pages_per_session
ORDER BY pages_per_session
"""),
]}


class MissingColumns(ValueError):
    """The events frame lacks a column the query needs."""


@contextmanager
def events_session(events: DataFrame) -> Iterator[SparkSession]:
    """A session with the caller's settings in which ``events`` is a view; nobody else's session gets a view of that name."""
    spark, name = events.sparkSession, f"events_{uuid.uuid4().hex}"
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    events.createGlobalTempView(name)
    try:
        own.sql(f"CREATE TEMPORARY VIEW events AS SELECT * FROM global_temp.{name}")
        yield own
    finally:
        spark.catalog.dropGlobalTempView(name)


def run_sql_folder(spark: SparkSession, events: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Every ``.sql`` file of a folder, by name: its text with ``events`` as a table.  A file that is one of the named queries and lacks columns is left out."""
    files = spark.read.text(f"{folder.rstrip('/')}/*.sql", wholetext=True).select("value", F.col("_metadata.file_name").alias("name"))
    out = {}
    with events_session(events) as own:
        for row in files.orderBy("name").collect():              # texts of queries
            name = row["name"].removesuffix(".sql")
            if name in QUERIES and QUERIES[name].missing(events.columns):
                continue
            out[name] = own.sql(row["value"].strip().rstrip(";"))
    return out


def run_sql(events: DataFrame, text: str) -> DataFrame:
    """One SQL text that reads the table ``events``, under any alias, as often as it likes."""
    with events_session(events) as own:
        return own.sql(text.strip().rstrip(";"))


def run_query(spark: SparkSession, events: DataFrame, name: str) -> DataFrame:
    """Plan one named query over ``events`` (lazy; nothing runs until an action)."""
    if name not in QUERIES:
        raise KeyError(f"unknown query {name!r}; available: {sorted(QUERIES)}")
    q = QUERIES[name]
    missing = q.missing(events.columns)
    if missing:
        raise MissingColumns(f"{name} needs columns {missing}")
    return spark.sql(q.sql, events=events)


def runnable(events: DataFrame) -> list[str]:
    """Names of the queries whose required columns all exist in ``events``."""
    return [n for n, q in QUERIES.items() if not q.missing(events.columns)]
