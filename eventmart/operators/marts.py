"""Materialised aggregate tables (marts) built from the events.

Each mart is one hash aggregate over a column-pruned scan; revenue columns are
added only when ``price`` exists, and a mart whose key column is absent is not
built.  Marts are written to a ``TableStore`` (Parquet on shared storage) and
read back, so reports reuse them instead of rescanning events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.expressions import round2
from eventmart.operators.topk import top_k_with_distinct
from eventmart.sources.lake import TableStore

MART_NAMES = ["daily_metrics", "top_products", "country_metrics", "category_metrics"]
TOP_PRODUCTS_KEPT = 50


def _counts(df: DataFrame, total_name: str = "total_events") -> list:
    aggs = [F.count(F.lit(1)).alias(total_name),
            F.count_distinct("session_id").alias("unique_sessions")]
    if "price" in df.columns:
        aggs.append(round2(F.sum("price")).alias("total_revenue"))
    return aggs


def daily_metrics(events: DataFrame) -> DataFrame:
    return events.groupBy(F.col("event_date_str").alias("event_date")).agg(*_counts(events))


def top_products(events: DataFrame, k: int = TOP_PRODUCTS_KEPT) -> DataFrame:
    """Products by views, keyed by product only; the top ``k`` are kept.
    Sessions are counted only for those ``k`` (``operators.topk``)."""
    priced = "price" in events.columns
    base = events.select("product_id", "session_id", *(["price"] if priced else []))
    aggs = [F.count(F.lit(1)).alias("view_count")]
    if priced:
        aggs.append(round2(F.sum("price")).alias("total_revenue"))
    return top_k_with_distinct(
        base, ["product_id"], aggs, [F.desc("view_count"), F.asc_nulls_last("product_id")], k,
        distinct="session_id", distinct_name="unique_sessions",
        columns=["product_id", "view_count", "unique_sessions", *(["total_revenue"] if priced else [])])


def country_metrics(events: DataFrame) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("total_events"),
            F.count_distinct("session_id").alias("unique_sessions")]
    return events.groupBy("country").agg(*aggs)


def category_metrics(events: DataFrame) -> DataFrame:
    return events.groupBy("category_name").agg(*_counts(events))


_BUILDERS = {
    "daily_metrics": (daily_metrics, "event_date_str"),
    "top_products": (top_products, "product_id"),
    "country_metrics": (country_metrics, "country"),
    "category_metrics": (category_metrics, "category_name"),
}


#: The event column that each mart is grouped by.
MART_KEYS = {name: key for name, (_, key) in _BUILDERS.items()}


def mart_plans(events: DataFrame) -> dict[str, DataFrame]:
    """The marts buildable from ``events`` (lazy), by name."""
    return {name: build(events) for name, (build, key) in _BUILDERS.items()
            if key in events.columns and "session_id" in events.columns}


def build_marts(store: TableStore, events: DataFrame) -> dict[str, DataFrame]:
    """Write every buildable mart (replacing an older one) and return them as
    read back from storage."""
    return store.write_all(mart_plans(events))
