"""Marts kept up to date input by input.

For every input of a lake a state is stored: events and revenue by (mart, key, session).  It is all that a mart
needs of an input, distinct sessions included, exactly.  A mart is the merge of the states; after a run
of the ETL only the inputs with a new version are read again, once for all marts.

A state is named after the lake's version that it was made of, and committed when it is whole, so a run that dies
leaves states of earlier versions, which the next run replaces.  The marts are written to the store last.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.expressions import round2
from eventmart.operators.marts import MART_KEYS, TOP_PRODUCTS_KEPT
from eventmart.operators.topk import top_k_with_distinct
from eventmart.sources.lake import SOURCE_COLUMN, WRITES_AT_ONCE, TableStore, checked_source, lake_snapshots, read_lake
from eventmart.sources.snapshots import Snapshots

_STATE = f"key string, session_id string, events long, revenue double, {SOURCE_COLUMN} string, _snapshot string, mart string"


def state_log(spark: SparkSession, store_root: str) -> Snapshots:
    return Snapshots(spark, f"{store_root.rstrip('/')}/_states", f"{SOURCE_COLUMN}={{name}}")


def session_states(events: DataFrame) -> DataFrame:
    """(mart, key, session_id, events, revenue) in one scan and one aggregate.  A column that the lake lacks counts as null,
    as it does for these events once another input has it."""
    text = lambda c: F.col(c).cast("string") if c in events.columns else F.lit(None).cast("string")
    price = F.col("price").cast("double") if "price" in events.columns else F.lit(None).cast("double")
    keys = F.explode(F.array(*[F.struct(F.lit(mart).alias("mart"), text(key).alias("key")) for mart, key in MART_KEYS.items()]))
    rows = events.select(keys.alias("at"), text("session_id").alias("session_id"), price.alias("price"))
    return (rows.groupBy("at.mart", "at.key", "session_id")
            .agg(F.count(F.lit(1)).alias("events"), F.sum("price").alias("revenue")))


def stale_inputs(lake: dict[str, str], states: dict[str, str]) -> dict[str, str]:
    """The lake's inputs, with their versions, that have no state of that version."""
    return {name: v for name, v in lake.items() if states.get(name, "").split("+")[0] != v}


def _write_state(events: DataFrame, log: Snapshots, name: str, lake_version: str) -> str:
    version = f"{lake_version}+{uuid.uuid4().hex[:8]}"
    session_states(events).write.mode("errorifexists").partitionBy("mart").parquet(log.folder(checked_source(name), version))
    return version


def _merged(states: DataFrame, mart: str, key_type, priced: bool) -> DataFrame:
    """One mart from the states of all inputs: the columns of a full rebuild."""
    name = {"daily_metrics": "event_date"}.get(mart, MART_KEYS[mart])
    rows = states.filter(F.col("mart") == mart).select(F.col("key").cast(key_type).alias(name), "session_id", "events", "revenue")
    revenue = [round2(F.sum("revenue")).alias("total_revenue")] if priced and mart != "country_metrics" else []
    if mart == "top_products":
        return top_k_with_distinct(
            rows, [name], [F.sum("events").alias("view_count"), *revenue], [F.desc("view_count"), F.asc_nulls_last(name)], TOP_PRODUCTS_KEPT,
            distinct="session_id", distinct_name="unique_sessions",
            columns=[name, "view_count", "unique_sessions", *(["total_revenue"] if priced else [])])
    return rows.groupBy(name).agg(F.sum("events").alias("total_events"), F.count_distinct("session_id").alias("unique_sessions"), *revenue)


def update_marts(store: TableStore, lake_path: str) -> tuple[dict[str, DataFrame], list[str]]:
    """Bring the store's marts up to the lake as it is now; the marts, and the inputs that were read for it."""
    spark = store.spark
    now, log = lake_snapshots(spark, lake_path).versions(), state_log(spark, store.root)
    stale = stale_inputs(now, log.versions())
    whole = read_lake(spark, lake_path, now)             # a filter on its input prunes the others' folders
    with ThreadPoolExecutor(WRITES_AT_ONCE) as pool:
        done = pool.map(lambda item: (item[0], _write_state(whole.filter(F.col(SOURCE_COLUMN) == item[0]), log, *item)), sorted(stale.items()))
        for name, version in done:
            log.commit(name, version)
    kept = log.versions()
    states = spark.read.schema(_STATE).option("basePath", log.root).parquet(*[log.folder(name, kept[name]) for name in sorted(now)])
    types = {f.name: f.dataType for f in whole.schema}
    built = {mart: _merged(states, mart, types[key], "price" in types) for mart, key in MART_KEYS.items() if key in types and "session_id" in types}
    return store.write_all(built), sorted(stale)
