"""Physical plans: pruning, pushdown and top-k are what we want at scale."""

import contextlib
import io

from pyspark.sql import functions as F

from eventmart.operators.etl import run_etl
from eventmart.plans.etl_runs import clickstream_raw, export_delimited
from eventmart.plans.queries import run_query
from eventmart.sources.lake import days_between, read_lake
from eventmart.sources.tables import ADAPTERS
from tests.conftest import SF001


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _subtrees(formatted: str, op: str) -> list[str]:
    """The operator tree under each ``op`` node of a formatted plan."""
    lines = formatted.split("\n\n")[0].splitlines()

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    out = []
    for i, line in enumerate(lines):
        if line.lstrip(" :+-").startswith(op):
            d, sub = depth(line), []
            for nxt in lines[i + 1:]:
                if depth(nxt) <= d:
                    break
                sub.append(nxt)
            out.append("\n".join(sub))
    return out


def test_scan_reads_only_needed_columns(spark):
    p = plan(run_query(spark, ADAPTERS["clickstream"](spark, SF001), "total_events_by_day"))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in p


def test_top_k_is_take_ordered(spark):
    p = plan(run_query(spark, ADAPTERS["sales"](spark, SF001), "top_products"))
    assert "TakeOrderedAndProject" in p


def test_aggregates_are_partial_then_final(spark):
    p = plan(run_query(spark, ADAPTERS["clickstream"](spark, SF001), "revenue_by_category"))
    assert "partial_count" in p and "HashAggregate" in p


def test_day_range_prunes_partitions(spark, workdir):
    export_delimited(clickstream_raw(spark, SF001), f"{workdir}/raw", ",")
    run_etl(spark, f"{workdir}/raw", f"{workdir}/lake")
    lake = read_lake(spark, f"{workdir}/lake")
    ranged = days_between(lake, "2024-01-10", "2024-01-12")
    p = plan(ranged.select("session_id"))
    assert "PartitionFilters: [isnotnull(event_date_str" in p
    assert "ReadSchema: struct<session_id:string>" in p
    assert {r[0] for r in ranged.select("event_date_str").distinct().collect()} == \
        {"2024-01-10", "2024-01-11", "2024-01-12"}


def test_lake_write_is_rebalanced(spark, workdir):
    from eventmart.sources.lake import write_lake
    df = spark.range(1000).select(F.lit("2024-01-01").alias("event_date_str"), "id")
    write_lake(df, f"{workdir}/lake", "a")
    assert read_lake(spark, f"{workdir}/lake").count() == 1000


def test_hot_day_is_split_across_files(spark, workdir):
    """One day holds a third of all rows: the rebalanced write cuts it into
    several tasks/files instead of funnelling it through one."""
    import glob
    from eventmart.sources.lake import write_lake
    n = 300_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01"))
         .otherwise(F.format_string("2024-02-%02d", (F.col("id") % 28 + 1).cast("int")))
         .alias("event_date_str"),
        F.col("id"), (F.col("id") * 7 % 1000).cast("double").alias("price"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        write_lake(df.repartition(16), f"{workdir}/lake", "a")
    finally:
        spark.conf.set(key, before)
    hot_files = glob.glob(f"{workdir}/lake/source_id=a/_snapshot=*/event_date_str=2024-01-01/*.parquet")
    cold_files = glob.glob(f"{workdir}/lake/source_id=a/_snapshot=*/event_date_str=2024-02-01/*.parquet")
    assert len(hot_files) > 1
    assert len(hot_files) > len(cold_files)
    assert read_lake(spark, f"{workdir}/lake").count() == n


def test_days_of_usual_size_are_not_cut(spark, workdir):
    """Many days dealt to few shuffle partitions: each partition is large, its days are not, so every day is one file."""
    import glob
    from eventmart.sources.lake import write_lake
    df = spark.range(120_000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int")).cast("string").alias("event_date_str"), F.col("id"))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k", "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        write_lake(df.repartition(16), f"{workdir}/lake", "a")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(glob.glob(f"{workdir}/lake/source_id=a/_snapshot=*/event_date_str=*/*.parquet")) == 60
    assert read_lake(spark, f"{workdir}/lake").agg(F.count("id"), F.count_distinct("id")).first() == (120_000, 120_000)


_ONE_DAY = """
import sys
sys.path.insert(0, sys.argv[1])
from eventmart.session import build_session
spark = build_session(master="local[2]", extra={"spark.driver.memory": "2g", "spark.eventLog.enabled": "true", "spark.eventLog.dir": sys.argv[2],
                                                "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
from eventmart.sources.lake import read_lake, write_lake
write_lake(spark.range(400_000).selectExpr("concat('2024-01-0', id % 1 + 1) AS event_date_str", "id"), sys.argv[3], "a")
assert read_lake(spark, sys.argv[3]).selectExpr("count(DISTINCT id)").first()[0] == 400_000
assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
spark.stop()
"""


def test_rows_of_a_day_are_not_held_to_be_written(workdir):
    """All rows are of one day: the task that writes them takes no memory for them."""
    import glob
    import json
    import os
    import subprocess
    import sys
    os.mkdir(f"{workdir}/log")
    subprocess.run([sys.executable, "-c", _ONE_DAY, os.path.dirname(os.path.dirname(os.path.abspath(__file__))), f"{workdir}/log", f"{workdir}/lake"], check=True, timeout=300)
    with open(*glob.glob(f"{workdir}/log/*"), encoding="utf-8") as f:
        tasks = [e["Task Metrics"] for e in map(json.loads, f) if e["Event"] == "SparkListenerTaskEnd"]
    writers = [t["Peak Execution Memory"] for t in tasks if t["Output Metrics"]["Records Written"]]
    assert writers and max(writers) < 1 << 20


def test_no_registered_query_broadcasts_or_reads_unused_columns(spark):
    """Named queries and jobs: no broadcast exchange, except the top-k ones,
    whose broadcast side is the k-row top list; no scan of the source's full
    column list."""
    import re
    import __spark_entry__ as E
    queries = E.queries()
    keys = [k for k in queries if k.startswith(("q_", "sales_", "mr_")) and "vs_sql" not in k
            or (k.startswith("report_") and k.endswith("_base"))]
    assert len(keys) >= 30
    full = {len(spark.read.parquet(f"{SF001}/{t}.parquet").columns) for t in ("events", "lineitem")}
    for key in keys:
        p = plan(queries[key](spark, SF001))
        if key.endswith(("top_products", "top_countries_base", "first_days_base")):
            # what Spark chooses to broadcast is the top list, k rows
            assert all("TakeOrderedAndProject" in t for t in _subtrees(p, "BroadcastExchange")), key
        else:
            assert "BroadcastExchange" not in p, key
        schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
        assert schemas, key
        for schema in schemas:
            assert len(schema.split(",")) not in full, (key, schema)


def test_count_distinct_shuffles_key_and_session_first(spark):
    """A hot key is spread over tasks by (key, session_id); the second
    exchange carries only per-task partial counts."""
    p = plan(run_query(spark, ADAPTERS["sales"](spark, SF001), "daily_active_users"))
    first = p.index("hashpartitioning(event_date#")
    assert "session_id" in p[first:p.index("\n", first)]
    assert p.count("Exchange") >= 2 and "partial_count(distinct" in p
