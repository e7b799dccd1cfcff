"""Run every named query and every job over one events frame.

A query or job whose columns are missing is skipped (and reported as such);
the others share one scan of the events (``shared_scan``) and may be saved as tables (``mr_<job>`` for jobs) and CSV.
The summary ``(kind, name, status, rows)`` is one lazy plan: row counts are
aggregates over the (saved) results, not driver-side loops over data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators.jobs import JOBS
from eventmart.operators.sinks import write_csv_if_any
from eventmart.plans.queries import QUERIES, run_query
from eventmart.plans.shared_scan import SharedScan
from eventmart.sources.lake import TableStore


def _status(spark, kind, name, status, rows: DataFrame | None) -> DataFrame:
    base = rows.agg(F.count(F.lit(1)).alias("rows")) if rows is not None \
        else spark.range(1).select(F.lit(0).cast("bigint").alias("rows"))
    return base.select(F.lit(kind).alias("kind"), F.lit(name).alias("name"),
                       F.lit(status).alias("status"), "rows")


def run_all(spark: SparkSession, events: DataFrame, store: TableStore | None = None,
            csv_dir: str | None = None, kind: str | None = None) -> DataFrame:
    """``kind``: ``query`` or ``job`` runs only those."""
    parts, wanted = [], kind
    items = [("query", n, q.missing(events.columns), (lambda n=n: run_query(spark, events, n)))
             for n, q in QUERIES.items()]
    items += [("job", n, j.missing(events.columns), (lambda j=j: j.run(events)))
              for n, j in JOBS.items()]
    items = [i for i in items if wanted in (None, i[0])]
    shared = SharedScan(events, [(kind, name) for kind, name, missing, _ in items if not missing])
    results = {(kind, name): shared.result(kind, name) if (kind, name) in shared.items else plan()
               for kind, name, missing, plan in items if not missing}
    tables = {(kind, name): name if kind == "query" else f"mr_{name}" for kind, name in results}
    if store is not None:
        saved = store.write_all({tables[item]: result for item, result in results.items()})
        results = {item: saved[tables[item]] for item in results}
    for kind, name, missing, _ in items:
        if missing:
            parts.append(_status(spark, kind, name, "skipped", None))
            continue
        result = results[kind, name]
        if csv_dir:
            write_csv_if_any(result, f"{csv_dir.rstrip('/')}/{tables[kind, name]}")
        parts.append(_status(spark, kind, name, "ok", result))
    return reduce(DataFrame.unionByName, parts)
