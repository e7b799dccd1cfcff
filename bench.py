"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3).

Headline set: the four published comparisons (event counts by type, by
country, revenue by category, events by day) in both the SQL layer and the job
API, plus the other named queries, all over the clickstream events; then the
same over the sales events (6x more rows).  Jobs
through the generic Python map/reduce API (``api_*``), the ETL, the marts, run-all and the job-vs-SQL check
run on the clickstream only.  Method: session start and one
untimed warm-up pass are excluded; each query is then timed end to end (plan +
run + collect) BENCH_REPEAT times and the median is reported.  ``value`` is the
sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventmart.operators import jobs, marts  # noqa: E402
from eventmart.operators.sinks import row_counts  # noqa: E402
from eventmart.plans import etl_runs  # noqa: E402
from eventmart.plans import mr_examples as mr  # noqa: E402
from eventmart.plans.queries import run_query  # noqa: E402
from eventmart.plans.run_all import run_all  # noqa: E402
from eventmart.session import build_session, run_dir  # noqa: E402
from eventmart.sources.lake import TableStore  # noqa: E402
from eventmart.sources.tables import ADAPTERS  # noqa: E402

# The SQL side of the published comparison (page-number counts for the type count).
COMPARISON_SQL = {name: sql for name, (sql, _) in jobs.COMPARISONS.items()}


def headline(spark, sf_dir):
    qs = {}
    for adapter, prefix in (("clickstream", ""), ("sales", "sales_")):
        def ev(a=adapter):
            return ADAPTERS[a](spark, sf_dir)
        for name, sql in COMPARISON_SQL.items():
            qs[f"{prefix}sql_{name}"] = (lambda s=sql, e=ev: spark.sql(s, events=e()))
            qs[f"{prefix}mr_{name}"] = (lambda n=name, e=ev: jobs.run_job(n, e()))
        for name in ("daily_active_users", "top_event_types", "top_products", "hourly_traffic",
                     "monthly_trends", "session_depth", "country_device_breakdown"):
            qs[f"{prefix}q_{name}"] = (lambda n=name, e=ev: run_query(spark, e(), n))
        if adapter == "clickstream":
            # jobs through the generic Python map/reduce API (pandas mapper with a
            # built-in reduce, and a reduce in Python)
            qs["api_event_count_by_type"] = lambda e=ev: mr.event_type_counts(e())
            qs["api_largest_prices"] = lambda e=ev: mr.category_largest_prices(e())
            qs["api_country_event_count"] = lambda e=ev: mr.country_sessions(e())
            # the parts that move the most data: raw files to lake, marts, everything at once
            qs["etl_clickstream"] = lambda: etl_runs.etl_clickstream(spark, sf_dir)
            qs["marts"] = lambda e=ev: row_counts(marts.build_marts(TableStore(spark, run_dir(spark, "bench")), e()))
            qs["run_all"] = lambda e=ev: run_all(spark, e(), TableStore(spark, run_dir(spark, "bench")))
            qs["job_vs_sql"] = lambda e=ev: jobs.job_vs_sql(spark, e())
    return qs


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session()
    qs = headline(spark, sf_dir)
    for fn in qs.values():          # warm-up: JIT, file listing caches, Python workers
        fn().collect()
    times = {}
    for name, fn in qs.items():
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn().collect()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 4),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
