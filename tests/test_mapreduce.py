"""Generic map/reduce API: skewed keys, tree combine, row functions, phase outputs."""

import glob

import pandas as pd
from pyspark.sql import functions as F

from eventmart.operators.mapreduce import (
    Combine, emit_pairs, key_sizes, map_reduce, per_row, phase_outputs, results_to_frame,
)


def _skewed(spark, n=30000):
    # one key holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("k"),
        (F.col("id") % 10).cast("double").alias("v"))


def _map_kv(pdf):
    return pd.DataFrame({"key": pdf["k"], "n": 1, "total": pdf["v"]})


def _combine(_key, v):
    return {"n": int(v["n"].sum()), "total": float(v["total"].sum())}


def test_tree_combine_matches_builtin_on_skewed_key(spark):
    df = _skewed(spark).repartition(16)
    red = Combine(_combine, lambda k, p: {"n": p["n"], "mean": p["total"] / p["n"]},
                  "n long, mean double")
    got = {r.key: (r.n, round(r.mean, 9)) for r in
           map_reduce(df, _map_kv, red, "key string, n long, total double", columns=["k", "v"]).collect()}
    want = {r.k: (r.n, round(r.mean, 9)) for r in
            df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean")).collect()}
    assert got == want
    assert got["hot"][0] == 10000


def test_tree_combine_without_finish_keeps_value_columns(spark):
    df = _skewed(spark, 3000)
    out = map_reduce(df, _map_kv, Combine(_combine), "key string, n long, total double", columns=["k", "v"])
    assert out.columns == ["key", "n", "total"]
    assert out.agg(F.sum("n")).first()[0] == 3000


def test_builtin_reduce_and_results_frame(spark):
    df = _skewed(spark, 3000)
    red = map_reduce(df, lambda p: pd.DataFrame({"key": p["k"], "value": 1}),
                     {"count": F.sum("value")}, "key string, value long", columns=["k"])
    top = results_to_frame(red, "k", "events").first()
    assert (top.k, top.events) == ("hot", 1000)


def test_row_function_zero_or_many_pairs(spark):
    df = spark.createDataFrame([("a", 2), ("b", 0), ("c", 3)], "name string, copies int")

    def fn(row):
        for i in range(row.get("copies", 0)):
            yield (row["name"], i)

    out = map_reduce(df, per_row(fn), {"n": F.count(F.lit(1)), "s": F.sum("value")},
                     "key string, value long")
    assert {r.key: (r.n, r.s) for r in out.collect()} == {"a": (2, 1), "c": (3, 3)}


def test_chained_jobs(spark):
    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("s"))
    stage1 = map_reduce(df, lambda p: pd.DataFrame({"key": p["s"], "value": 1}),
                        {"depth": F.sum("value")}, "key string, value long")
    stage2 = map_reduce(stage1, lambda p: pd.DataFrame({"key": p["depth"], "value": 1}),
                        {"sessions": F.sum("value")}, "key long, value long")
    assert {r.key: r.sessions for r in stage2.collect()} == {15: 2, 14: 5}


def test_phase_outputs(spark, workdir):
    df = _skewed(spark, 12000)
    mapper = lambda p: pd.DataFrame({"key": p["k"], "value": 1})
    pairs = emit_pairs(df, mapper, "key string, value long", ["k"])
    reduced = map_reduce(df, mapper, {"a": F.sum("value"), "b": F.count(F.lit(1))},
                         "key string, value long", columns=["k"], output_dir=workdir, job_name="j/1")
    views = phase_outputs(pairs, reduced)
    assert views["map"].count() == 12000
    assert views["shuffle"].agg(F.sum("value_count")).first()[0] == 12000
    hot = views["reduce"].filter("key = 'hot'").first().reduced_value
    assert hot == '{"a":4000,"b":4000}'
    for phase in ("map", "shuffle", "reduce"):
        assert glob.glob(f"{workdir}/j_1_{phase}_output/part-*.csv")
    assert spark.read.option("header", True).csv(f"{workdir}/j_1_map_output").count() == 12000
    assert key_sizes(pairs).count() == 98


def test_job_with_outputs_maps_once(spark, workdir):
    seen = spark.sparkContext.accumulator(0)

    def mapper(pdf):
        seen.add(len(pdf))
        return pd.DataFrame({"key": pdf["k"], "value": 1})

    out = map_reduce(_skewed(spark, 3000), mapper, {"n": F.sum("value")}, "key string, value long", columns=["k"], output_dir=workdir)
    assert out.agg(F.sum("n")).first()[0] == 3000 and seen.value == 3000


def test_missing_value_is_no_session(spark):
    from eventmart.plans.mr_examples import country_sessions
    df = spark.createDataFrame([("PL", 1), ("PL", None), ("PL", 9007199254740993), (None, 1), ("", None)], "country string, session_id long")
    assert {r.country: (r.total_events, r.unique_sessions) for r in country_sessions(df).collect()} == {"PL": (3, 2), "unknown": (2, 1)}


def test_combine_streams_small_batches(spark):
    # tiny Arrow batches: every group of the later levels spans many batches; null keys stay one group
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .when(F.col("id") % 11 == 0, F.lit(None))
         .otherwise((F.col("id") % 53).cast("string")).alias("k"),
        (F.col("id") % 10).cast("double").alias("v")).repartition(8)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        red = Combine(_combine)
        got = {r.key: (r.n, r.total) for r in
               map_reduce(df, _map_kv, red, "key string, n long, total double",
                          columns=["k", "v"]).collect()}
    finally:
        spark.conf.set(key, before)
    want = {r.k: (r.n, r.total) for r in
            df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")).collect()}
    assert got == want
    assert None in got and got["hot"][0] == 6667
