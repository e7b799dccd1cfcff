"""The seven analytics jobs, written as column expressions.

Each job is ``events -> DataFrame``: a key expression, built-in aggregates and a
sort.  Spark runs them as partial aggregate -> exchange on the key -> final
aggregate, i.e. the map/combine/reduce of a MapReduce job without shipping
value lists.  Semantics follow the job API, which differs from the SQL layer in
two places (kept on purpose):

* keys fall back through ``a or b or default`` (null, empty text and numeric
  zero fall through), and missing prices count as 0;
* ``avg_price`` is the *rounded* total divided by the count, then rounded.

``JOBS`` is the registry (name -> function, required columns); ``run_job`` runs
one by name, ``run_all_jobs`` runs each whose columns exist.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.expressions import as_double, first_truthy, round2
from eventmart.operators.topk import top_k_with_distinct


def _price0(df: DataFrame):
    """Price as a number, 0 when missing or not a number."""
    return F.coalesce(as_double(df, "price"), F.lit(0.0)) if "price" in df.columns else F.lit(0.0)


def event_count_by_type(df: DataFrame) -> DataFrame:
    key = first_truthy(df, ["event_type", "page_number"], default="unknown")
    return (df.groupBy(key.alias("event_type"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(F.desc("event_count"), F.asc("event_type")))


def country_event_count(df: DataFrame) -> DataFrame:
    key = first_truthy(df, ["country"], default="unknown")
    return (df.groupBy(key.alias("country"))
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_distinct("session_id").alias("unique_sessions"))
            .orderBy(F.desc("total_events"), F.asc("country")))


def revenue_by_category(df: DataFrame) -> DataFrame:
    key = first_truthy(df, ["category_name", "category_id"], default="Other")
    price = _price0(df)
    total = round2(F.sum(price))
    n = F.count(F.lit(1))
    return (df.groupBy(key.alias("category_name"))
            .agg(total.alias("total_revenue"),
                 n.alias("event_count"),
                 round2(total / n).alias("avg_price"),
                 round2(F.min(price)).alias("min_price"),
                 round2(F.max(price)).alias("max_price"))
            .orderBy(F.desc("total_revenue"), F.asc("category_name")))


def total_events_by_day(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.col("event_date_str").alias("event_date"))
            .agg(F.count(F.lit(1)).alias("total_events"))
            .orderBy(F.asc_nulls_last("event_date")))


def daily_active_users(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.col("event_date_str").alias("event_date"))
            .agg(F.count_distinct("session_id").alias("active_users"))
            .orderBy(F.asc_nulls_last("event_date")))


def top_products(df: DataFrame, k: int = 25) -> DataFrame:
    """Top ``k`` products by views (keyed by product only).  Sessions are
    counted only for the top ``k`` (``operators.topk``)."""
    base = df.select(F.col("product_id").cast("string").alias("product_id"),
                     _price0(df).alias("_price"), "session_id")
    total = round2(F.sum("_price"))
    n = F.count(F.lit(1))
    return top_k_with_distinct(
        base, ["product_id"],
        [n.alias("view_count"), round2(total / n).alias("avg_price"), total.alias("total_revenue")],
        [F.desc("view_count"), F.asc_nulls_last("product_id")], k,
        distinct="session_id", distinct_name="unique_sessions",
        columns=["product_id", "view_count", "unique_sessions", "avg_price", "total_revenue"])


def pages_per_session(df: DataFrame) -> DataFrame:
    """Stage 1 of session depth: events per session (a null session is one group)."""
    return df.groupBy("session_id").agg(F.count(F.lit(1)).alias("pages_per_session"))


def session_depth(df: DataFrame) -> DataFrame:
    """Two chained aggregations: events per session, then sessions per depth."""
    return (pages_per_session(df)
            .groupBy("pages_per_session")
            .agg(F.count(F.lit(1)).alias("session_count"))
            .orderBy("pages_per_session"))


@dataclass(frozen=True)
class Job:
    name: str
    run: Callable[[DataFrame], DataFrame]
    requires: frozenset

    def missing(self, columns) -> list[str]:
        return sorted(self.requires - set(columns))


JOBS: dict[str, Job] = {j.name: j for j in [
    Job("event_count_by_type", event_count_by_type, frozenset()),
    Job("country_event_count", country_event_count, frozenset({"country", "session_id"})),
    Job("revenue_by_category", revenue_by_category, frozenset({"price"})),
    Job("total_events_by_day", total_events_by_day, frozenset({"event_date_str"})),
    Job("daily_active_users", daily_active_users, frozenset({"event_date_str", "session_id"})),
    Job("top_products", top_products, frozenset({"product_id", "session_id"})),
    Job("session_depth", session_depth, frozenset({"session_id"})),
]}


def run_job(name: str, events: DataFrame) -> DataFrame:
    if name not in JOBS:
        raise KeyError(f"unknown job {name!r}; available: {sorted(JOBS)}")
    job = JOBS[name]
    missing = job.missing(events.columns)
    if missing:
        raise ValueError(f"job {name} needs columns {missing}")
    return job.run(events)


def run_all_jobs(events: DataFrame) -> dict[str, DataFrame]:
    """Every job whose columns exist (skipped ones are simply absent)."""
    return {n: j.run(events) for n, j in JOBS.items() if not j.missing(events.columns)}


# --- job API vs SQL layer ---------------------------------------------------

# The SQL each job is compared with, and the columns both produce.
COMPARISONS = {
    "event_count_by_type": ("""
        SELECT CAST(page_number AS STRING) AS event_type, COUNT(*) AS event_count
        FROM {events} GROUP BY page_number ORDER BY event_count DESC""", ["event_type", "event_count"]),
    "country_event_count": ("""
        SELECT country, COUNT(*) AS total_events, COUNT(DISTINCT session_id) AS unique_sessions
        FROM {events} GROUP BY country ORDER BY total_events DESC""", ["country", "total_events", "unique_sessions"]),
    "revenue_by_category": ("""
        SELECT category_name, ROUND(SUM(price) * 100) / 100 AS total_revenue,
               COUNT(*) AS event_count, ROUND(AVG(price) * 100) / 100 AS avg_price
        FROM {events} GROUP BY category_name ORDER BY total_revenue DESC""", ["category_name", "total_revenue", "event_count"]),
    "total_events_by_day": ("""
        SELECT event_date_str AS event_date, COUNT(*) AS total_events
        FROM {events} GROUP BY event_date_str ORDER BY event_date""", ["event_date", "total_events"]),
}
# The job divides its rounded total, the SQL averages prices: a pair of its own.
AVERAGES = ("revenue_by_category_average", "revenue_by_category", ["category_name", "avg_price"])


def job_vs_sql(spark, events: DataFrame) -> DataFrame:
    """``(pair, only_in_job, only_in_sql)``: rows each side has that the other
    lacks, on the columns both produce.  All zero when the two APIs agree.  Each side runs once: its rows
    count +1 or -1, and the sum over equal rows tells which side has more.

    The type job prefers ``event_type`` over ``page_number``; the SQL groups by
    page number, so that job runs on the frame without ``event_type``."""
    pairs = [(name, name, columns) for name, (_, columns) in COMPARISONS.items()]
    parts = []
    for pair, name, columns in [*pairs, AVERAGES]:
        src = events.drop("event_type") if name == "event_count_by_type" else events
        job = JOBS[name].run(src).select(*columns, F.lit(1).alias("side"))
        ref = spark.sql(COMPARISONS[name][0], events=events).select(*columns, F.lit(-1).alias("side"))
        balance = job.unionAll(ref).groupBy(*columns).agg(F.sum("side").alias("side"))
        parts += [balance.select(F.lit(pair).alias("pair"), "side"), spark.range(1).select(F.lit(pair), F.lit(0).cast("bigint"))]
    return (reduce(DataFrame.unionAll, parts)
            .groupBy("pair")
            .agg(F.sum(F.greatest("side", F.lit(0))).cast("bigint").alias("only_in_job"),
                 F.sum(F.greatest(-F.col("side"), F.lit(0))).cast("bigint").alias("only_in_sql")))
