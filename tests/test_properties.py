"""Invariants across APIs and routes on the benchmark tables."""

from pyspark.sql import functions as F

from eventmart.operators import jobs, marts
from eventmart.operators.report import Report
from eventmart.plans.queries import run_query, runnable
from eventmart.sources.lake import TableStore
from eventmart.sources.tables import ADAPTERS
from tests.conftest import SF01


def _ev(spark, adapter="clickstream"):
    return ADAPTERS[adapter](spark, SF01)


def test_totals_equal_row_count(spark):
    for adapter in ADAPTERS:
        ev = _ev(spark, adapter)
        n = ev.count()
        for name in ("total_events_by_day", "top_event_types", "revenue_by_category",
                     "country_device_breakdown", "hourly_traffic", "monthly_trends"):
            assert run_query(spark, ev, name).agg(F.sum("total_events")).first()[0] == n
        depth = run_query(spark, ev, "session_depth")
        assert depth.agg(F.sum(F.col("pages_per_session") * F.col("session_count"))).first()[0] == n


def test_job_session_depth_equals_sql(spark):
    ev = _ev(spark)
    a = jobs.session_depth(ev)
    b = run_query(spark, ev, "session_depth")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_job_vs_sql_all_zero(spark):
    rows = jobs.job_vs_sql(spark, _ev(spark)).collect()
    assert len(rows) == 5 and all(r.only_in_job == 0 and r.only_in_sql == 0 for r in rows if not r.pair.endswith("average"))


def test_mart_route_equals_base_route(spark, workdir):
    ev = _ev(spark)
    store = TableStore(spark, workdir)
    marts.build_marts(store, ev)
    with_marts, base = Report(ev, store), Report(ev)
    assert with_marts.route("daily_metrics") == "mart" and base.route("daily_metrics") == "base"
    for section in ("overview", "first_days", "top_countries", "daily_volume", "category_share"):
        a, b = getattr(with_marts, section)(), getattr(base, section)()
        assert a.collect() == b.collect(), section
    assert set(TableStore(spark, workdir).names()) == set(marts.MART_NAMES)
    assert [c for c, _ in with_marts.schema_preview()][:2] == ["event_date", "total_events"]


def test_missing_columns_skip(spark):
    ev = _ev(spark).drop("price", "country")
    names = runnable(ev)
    assert "revenue_by_category" not in names and "country_device_breakdown" not in names
    assert "session_depth" in names
    assert "revenue_by_category" not in jobs.run_all_jobs(ev)
    assert "total_revenue" not in marts.daily_metrics(ev).columns
    assert "country_metrics" not in marts.mart_plans(ev)


def test_shared_dir_is_the_session_checkpoint_dir(spark):
    from eventmart.session import run_dir, shared_dir
    d = shared_dir(spark)
    assert d and run_dir(spark, "x").startswith(f"{d}/eventmart/{spark.sparkContext.applicationId}-")
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_top_k_with_distinct_matches_direct_form(spark):
    """Top-k first, then distinct counts for those groups only: same rows as
    the direct aggregate, with a null key, a hot key and ties."""
    from pyspark.sql import functions as F
    from eventmart.operators.topk import top_k_with_distinct
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .when(F.col("id") % 7 == 0, F.lit(None))
         .otherwise((F.col("id") % 40).cast("string")).alias("p"),
        (F.col("id") % 17).alias("s"))
    order = [F.desc("n"), F.asc_nulls_last("p")]
    got = top_k_with_distinct(df, ["p"], [F.count(F.lit(1)).alias("n")], order, 6,
                              distinct="s", distinct_name="u", columns=["p", "n", "u"])
    want = (df.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("s").alias("u"))
            .orderBy(*order).limit(6))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert None in [r.p for r in got.collect()]
