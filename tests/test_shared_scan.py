"""Run-all from shared scans: the same results as the single plans, and how often the events are read."""

import pytest
from pyspark.sql import functions as F

from eventmart.operators.jobs import JOBS
from eventmart.plans.queries import QUERIES, run_query
from eventmart.plans.run_all import run_all
from eventmart.plans.shared_scan import NEEDS, SharedScan
from eventmart.sources.tables import ADAPTERS
from tests.conftest import SF001


def _single(spark, events, kind, name):
    return run_query(spark, events, name) if kind == "query" else JOBS[name].run(events)


def _same(spark, events):
    ready = [("query", n) for n, q in QUERIES.items() if not q.missing(events.columns)] + [("job", n) for n, j in JOBS.items() if not j.missing(events.columns)]
    shared = SharedScan(events, ready)
    for item in shared.items:
        got, want = shared.result(*item), _single(spark, events, *item)
        assert got.dtypes == want.dtypes, item
        # sums are added up in another order, so a second decimal may differ by one
        assert [tuple(r) for r in got.collect()] == [tuple(pytest.approx(v, abs=0.011) if isinstance(v, float) else v for v in r) for r in want.collect()], item
    return shared


def test_needs_cover_every_query_and_job():
    assert set(NEEDS) == {("query", n) for n in QUERIES} | {("job", n) for n in JOBS}


@pytest.mark.parametrize("adapter", sorted(ADAPTERS))
def test_shared_results_equal_single_plans(spark, adapter):
    events = ADAPTERS[adapter](spark, SF001)
    shared = _same(spark, events)
    assert shared.items == shared.wanted


def test_null_keys_sessions_and_prices(spark):
    odd = ADAPTERS["clickstream"](spark, SF001).withColumns({
        "session_id": F.expr("if(session_id % 3 = 0, null, session_id)"), "price": F.expr("if(page_number = 2, null, price)"),
        "country": F.expr("case when country < '2' then null when country < '22' then '' else country end"),
        "category_name": F.expr("if(page_number = 2, null, category_name)"), "product_id": F.expr("if(page_number < 4, null, product_id)"),
        "event_date": F.expr("if(page_number = 1, null, event_date)"), "event_date_str": F.expr("if(page_number = 1, null, event_date_str)"),
        "event_month": F.expr("if(page_number = 1, null, event_month)"), "event_hour": F.expr("if(page_number = 1, null, event_hour)")})
    _same(spark, odd)
    _same(spark, odd.limit(0))


def test_missing_columns_and_prices_of_another_type(spark):
    events = ADAPTERS["clickstream"](spark, SF001)
    _same(spark, events.drop("price"))
    _same(spark, events.drop("session_id"))
    text = events.withColumn("price", F.col("price").cast("decimal(18,4)"))
    shared = _same(spark, text)
    assert shared.items == [i for i in shared.wanted if not NEEDS[i][1]]


def test_events_are_read_twice_at_most(spark):
    events = ADAPTERS["clickstream"](spark, SF001)
    read = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    n = events.count()
    rows = run_all(spark, events.mapInPandas(count, events.schema)).collect()
    assert {r.status for r in rows} == {"ok"} and len(rows) == 16
    assert n <= read.value <= 2 * n
