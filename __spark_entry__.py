"""

``queries()`` maps a key to ``f(spark, sf_dir) -> DataFrame``; ``oracle_sql()``
gives, for the same key, DuckDB SQL over the benchmark tables (registered there
as views).  Keys without an oracle are checked by row count only.

Every query reads whole benchmark tables through an adapter
(``eventmart.sources.tables``) that maps them onto the canonical event schema.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators import jobs, marts
from eventmart.operators.etl import column_profile
from eventmart.operators.report import Report, report_summary, schema_frame
from eventmart.operators.sinks import preview, read_csv, row_counts, write_csv
from eventmart.plans.run_all import run_all
from eventmart.session import run_dir
from eventmart.sources.lake import TableStore
from eventmart.plans import etl_runs
from eventmart.plans import mr_examples as mr
from eventmart.plans import oracle
from eventmart.plans.queries import QUERIES, run_query, run_sql_folder
from eventmart.sources.tables import ADAPTERS

FLAGSHIP_SF = "/root/testdata/sf0.001"

QueryFn = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------------------
# registry: key -> (adapter, f(spark, events) -> DataFrame, oracle body over `ev`)
# ---------------------------------------------------------------------------

_REG: dict[str, tuple[str, Callable[[SparkSession, DataFrame], DataFrame], str | None]] = {}


def _add(key, adapter, fn, oracle_body):
    _REG[key] = (adapter, fn, oracle_body)


# Q1-Q9 on both adapters
for _prefix, _adapter in (("q", "clickstream"), ("sales", "sales")):
    for _name, _q in QUERIES.items():
        _add(f"{_prefix}_{_name}", _adapter,
             (lambda n: lambda spark, ev: run_query(spark, ev, n))(_name),
             _q.plain_sql.replace("{events}", "ev"))

# The jobs as column expressions (job semantics: fallbacks, price 0, rounded avg)
_TOTAL0 = "ROUND(SUM(COALESCE(price, 0)) * 100) / 100"
_JOB_ORACLES = {
    "event_count_by_type": """
SELECT COALESCE(NULLIF(event_type, ''),
                CASE WHEN page_number <> 0 THEN CAST(page_number AS VARCHAR) END,
                'unknown') AS event_type,
       COUNT(*) AS event_count
FROM ev GROUP BY 1""",
    "country_event_count": """
SELECT COALESCE(NULLIF(country, ''), 'unknown') AS country,
       COUNT(*) AS total_events, COUNT(DISTINCT session_id) AS unique_sessions
FROM ev GROUP BY 1""",
    "revenue_by_category": f"""
SELECT COALESCE(NULLIF(category_name, ''),
                CASE WHEN category_id <> 0 THEN CAST(category_id AS VARCHAR) END,
                'Other') AS category_name,
       {_TOTAL0} AS total_revenue,
       COUNT(*) AS event_count,
       ROUND(({_TOTAL0}) / COUNT(*) * 100) / 100 AS avg_price,
       ROUND(MIN(COALESCE(price, 0)) * 100) / 100 AS min_price,
       ROUND(MAX(COALESCE(price, 0)) * 100) / 100 AS max_price
FROM ev GROUP BY 1""",
    "total_events_by_day": """
SELECT event_date_str AS event_date, COUNT(*) AS total_events FROM ev GROUP BY 1""",
    "daily_active_users": """
SELECT event_date_str AS event_date, COUNT(DISTINCT session_id) AS active_users
FROM ev GROUP BY 1""",
    "top_products": f"""
SELECT CAST(product_id AS VARCHAR) AS product_id,
       COUNT(*) AS view_count,
       COUNT(DISTINCT session_id) AS unique_sessions,
       ROUND(({_TOTAL0}) / COUNT(*) * 100) / 100 AS avg_price,
       {_TOTAL0} AS total_revenue
FROM ev GROUP BY 1
ORDER BY view_count DESC, product_id
LIMIT 25""",
    "session_depth": QUERIES["session_depth"].plain_sql.replace("{events}", "ev"),
}
for _name in jobs.JOBS:
    _add(f"mr_{_name}", "clickstream",
         (lambda n: lambda spark, ev: jobs.run_job(n, ev))(_name), _JOB_ORACLES[_name])
_add("mr_sales_event_count_by_type", "sales",
     lambda spark, ev: jobs.run_job("event_count_by_type", ev), _JOB_ORACLES["event_count_by_type"])
_add("mr_sales_top_products", "sales",
     lambda spark, ev: jobs.run_job("top_products", ev), _JOB_ORACLES["top_products"])

# B1: job API vs SQL layer on the same frame
_JOB_SIDES = {
    "event_count_by_type": ("SELECT CAST(page_number AS VARCHAR) AS k, COUNT(*) AS n FROM ev GROUP BY 1", "SELECT CAST(page_number AS VARCHAR) AS k, COUNT(*) AS n FROM ev GROUP BY page_number"),
    "country_event_count": (f"SELECT country, total_events, unique_sessions FROM ({_JOB_ORACLES['country_event_count']}) j", "SELECT country, COUNT(*), COUNT(DISTINCT session_id) FROM ev GROUP BY country"),
    "revenue_by_category": (f"SELECT category_name, total_revenue, event_count FROM ({_JOB_ORACLES['revenue_by_category']}) j", "SELECT category_name, ROUND(SUM(price) * 100) / 100, COUNT(*) FROM ev GROUP BY category_name"),
    "total_events_by_day": (f"SELECT event_date, total_events FROM ({_JOB_ORACLES['total_events_by_day']}) j", "SELECT event_date_str, COUNT(*) FROM ev GROUP BY event_date_str"),
    "revenue_by_category_average": (f"SELECT category_name, avg_price FROM ({_JOB_ORACLES['revenue_by_category']}) j", "SELECT category_name, ROUND(AVG(price) * 100) / 100 FROM ev GROUP BY category_name"),
}
_JOB_VS_SQL = "\nUNION ALL\n".join(
    f"SELECT '{pair}' AS pair, (SELECT COUNT(*) FROM (({job}) EXCEPT ALL ({sql})) a) AS only_in_job, (SELECT COUNT(*) FROM (({sql}) EXCEPT ALL ({job})) b) AS only_in_sql"
    for pair, (job, sql) in _JOB_SIDES.items())
_add("job_vs_sql", "clickstream", jobs.job_vs_sql, _JOB_VS_SQL)
_add("sales_job_vs_sql", "sales", jobs.job_vs_sql, _JOB_VS_SQL)

# M1/M3/K5: the generic map/reduce API
_add("mapreduce_generic", "clickstream", lambda spark, ev: mr.event_type_counts(ev), """
SELECT event_type, COUNT(*) AS event_count FROM ev GROUP BY event_type""")
_add("mapreduce_multi_emit", "clickstream", lambda spark, ev: mr.type_and_country_counts(ev), """
SELECT key, COUNT(*) AS pairs FROM (
    SELECT 'type:' || event_type AS key FROM ev WHERE event_type <> 'error'
    UNION ALL
    SELECT 'country:' || country AS key FROM ev WHERE event_type <> 'error') p
GROUP BY key""")
_add("mapreduce_chained", "clickstream", lambda spark, ev: mr.chained_session_depth(ev),
     QUERIES["session_depth"].plain_sql.replace("{events}", "ev"))
_add("mapreduce_combine", "clickstream", lambda spark, ev: mr.category_largest_prices(ev), """
SELECT category_name, MAX(price) FILTER (place = 1) AS first, MAX(price) FILTER (place = 2) AS second,
       MAX(price) FILTER (place = 3) AS third
FROM (SELECT category_name, price, ROW_NUMBER() OVER (PARTITION BY category_name ORDER BY price DESC) AS place FROM ev) r
GROUP BY category_name""")
_COUNTRY_SESSIONS = """
SELECT COALESCE(NULLIF(country, ''), 'unknown') AS country, COUNT(*) AS total_events, COUNT(DISTINCT {session}) AS unique_sessions
FROM ev GROUP BY 1"""
_add("mapreduce_row_fn", "clickstream", lambda spark, ev: mr.country_sessions(ev), _COUNTRY_SESSIONS.format(session="session_id"))
# events without a session: they count as events and as no session
_SOME = "CASE WHEN session_id % 10 <> 0 THEN session_id END"
_add("mapreduce_null_sessions", "clickstream",
     lambda spark, ev: mr.country_sessions(ev.withColumn("session_id", F.expr(_SOME))), _COUNTRY_SESSIONS.format(session=_SOME))
_add("q_null_sessions_daily_active_users", "clickstream",
     lambda spark, ev: run_query(spark, ev.withColumn("session_id", F.expr(_SOME)), "daily_active_users"),
     QUERIES["daily_active_users"].plain_sql.replace("{events}", "ev").replace("COUNT(DISTINCT session_id)", f"COUNT(DISTINCT {_SOME})"))
_add("mr_null_sessions_session_depth", "clickstream",
     lambda spark, ev: jobs.run_job("session_depth", ev.withColumn("session_id", F.expr(_SOME))),
     QUERIES["session_depth"].plain_sql.replace("{events}", "ev").replace("SELECT session_id,", f"SELECT {_SOME} AS s,").replace("GROUP BY session_id", "GROUP BY 1"))
_add("mapreduce_map_pairs", "clickstream", lambda spark, ev: mr.event_type_map_pairs(ev), """
SELECT event_type AS key, CAST(1 AS BIGINT) AS value FROM ev""")
_add("mapreduce_results_frame", "clickstream", lambda spark, ev: mr.event_type_results(ev), """
SELECT ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, event_type) - 1 AS place, event_type, COUNT(*) AS event_count FROM ev GROUP BY event_type""")
_add("mapreduce_key_sizes", "clickstream", lambda spark, ev: mr.event_type_key_sizes(ev), """
SELECT event_type AS key, COUNT(*) AS value_count FROM ev GROUP BY event_type""")
_add("mapreduce_reduced_json", "clickstream", lambda spark, ev: mr.country_reduced_json(ev), """
SELECT country AS key,
       CAST(json_object('total_events', COUNT(*),
                        'unique_sessions', COUNT(DISTINCT CAST(session_id AS VARCHAR))) AS VARCHAR)
           AS reduced_value
FROM ev GROUP BY country""")

# Marts written to a table store, read back
def _store(spark: SparkSession, ev: DataFrame, names) -> TableStore:
    store = TableStore(spark, run_dir(spark, "marts"))
    plans = marts.mart_plans(ev)
    for n in names:
        store.write(n, plans[n])
    return store


_MART_ORACLES = {
    "daily_metrics": """
SELECT event_date_str AS event_date, COUNT(*) AS total_events,
       COUNT(DISTINCT session_id) AS unique_sessions,
       ROUND(SUM(price) * 100) / 100 AS total_revenue
FROM ev GROUP BY event_date_str""",
    "top_products": """
SELECT product_id, COUNT(*) AS view_count, COUNT(DISTINCT session_id) AS unique_sessions,
       ROUND(SUM(price) * 100) / 100 AS total_revenue
FROM ev GROUP BY product_id ORDER BY view_count DESC, product_id LIMIT 50""",
    "country_metrics": """
SELECT country, COUNT(*) AS total_events, COUNT(DISTINCT session_id) AS unique_sessions
FROM ev GROUP BY country""",
    "category_metrics": """
SELECT category_name, COUNT(*) AS total_events, COUNT(DISTINCT session_id) AS unique_sessions,
       ROUND(SUM(price) * 100) / 100 AS total_revenue
FROM ev GROUP BY category_name""",
}
for _name in marts.MART_NAMES:
    _add(f"mart_{_name}", "clickstream",
         (lambda n: lambda spark, ev: _store(spark, ev, [n]).read(n))(_name), _MART_ORACLES[_name])
    _add(f"mart_sales_{_name}", "sales",
         (lambda n: lambda spark, ev: _store(spark, ev, [n]).read(n))(_name), _MART_ORACLES[_name])
_add("mart_without_price", "clickstream",
     lambda spark, ev: _store(spark, ev.drop("price"), ["daily_metrics"]).read("daily_metrics"), """
SELECT event_date_str AS event_date, COUNT(*) AS total_events,
       COUNT(DISTINCT session_id) AS unique_sessions
FROM ev GROUP BY event_date_str""")

# K7: tables and their row counts
_add("catalog_row_counts", "clickstream",
     lambda spark, ev: row_counts(_store(spark, ev, marts.MART_NAMES).tables()), """
SELECT 'category_metrics' AS table_name, COUNT(DISTINCT category_name) AS row_count FROM ev
UNION ALL SELECT 'country_metrics', COUNT(DISTINCT country) FROM ev
UNION ALL SELECT 'daily_metrics', COUNT(DISTINCT event_date_str) FROM ev
UNION ALL SELECT 'top_products', LEAST(50, COUNT(DISTINCT product_id)) FROM ev""")

# K2 / K6: a result written as CSV and read back; the first rows of a result
def _csv_roundtrip(name: str):
    def run(spark: SparkSession, ev: DataFrame) -> DataFrame:
        result = run_query(spark, ev, name)
        path = run_dir(spark, f"csv-{name}")
        write_csv(result, path)
        return read_csv(spark, path, result.schema)
    return run


_add("csv_daily_active_users", "clickstream", _csv_roundtrip("daily_active_users"),
     QUERIES["daily_active_users"].plain_sql.replace("{events}", "ev"))
_add("csv_sales_revenue_by_category", "sales", _csv_roundtrip("revenue_by_category"),
     QUERIES["revenue_by_category"].plain_sql.replace("{events}", "ev"))
_add("preview_total_events_by_day", "sales",
     lambda spark, ev: preview(run_query(spark, ev, "total_events_by_day"), 10),
     QUERIES["total_events_by_day"].plain_sql.replace("{events}", "ev") + "\nLIMIT 10")

# Optional-column profile (device is absent from these events)
_add("optional_column_profile", "clickstream", lambda spark, ev: column_profile(ev), """
SELECT * FROM (VALUES
  ('price', true, (SELECT COUNT(price) FROM ev), 'revenue analytics'),
  ('country', true, (SELECT COUNT(country) FROM ev), 'geography breakdown'),
  ('product_id', true, (SELECT COUNT(product_id) FROM ev), 'top products analysis'),
  ('category_id', true, (SELECT COUNT(category_id) FROM ev), 'category analytics'),
  ('device', false, CAST(0 AS BIGINT), 'device breakdown'),
  ('event_type', true, (SELECT COUNT(event_type) FROM ev), 'event type analytics'))
  t(column_name, present, non_null_rows, purpose)""")

# Report sections, from marts ("mart") and from raw events ("base")
_REPORT_MARTS = {
    "overview": ["daily_metrics"], "first_days": ["daily_metrics"],
    "top_products": ["top_products"], "categories": ["category_metrics"],
    "top_countries": ["country_metrics"], "daily_volume": ["daily_metrics"],
    "category_share": ["category_metrics"],
}
_REPORT_ORACLES = {
    "overview": {"both": """
SELECT COUNT(*) AS total_events, COUNT(DISTINCT event_date_str) AS total_days FROM ev"""},
    "first_days": {"both": """
SELECT event_date_str AS event_date, COUNT(*) AS total_events,
       COUNT(DISTINCT session_id) AS unique_sessions
FROM ev GROUP BY event_date_str ORDER BY event_date_str LIMIT 15"""},
    "top_products": {
        "mart": """
SELECT product_id, COUNT(*) AS view_count, COUNT(DISTINCT session_id) AS unique_sessions,
       ROUND(SUM(price) * 100) / 100 AS total_revenue
FROM ev GROUP BY product_id ORDER BY view_count DESC, product_id LIMIT 10""",
        "base": """
SELECT product_id, category_name, COUNT(*) AS view_count, ROUND(AVG(price) * 100) / 100 AS avg_price
FROM ev GROUP BY product_id, category_name
ORDER BY view_count DESC, product_id, category_name LIMIT 10"""},
    "categories": {
        "mart": _MART_ORACLES["category_metrics"],
        "base": """
SELECT category_name, COUNT(*) AS total_events, ROUND(SUM(price) * 100) / 100 AS total_revenue,
       ROUND(AVG(price) * 100) / 100 AS avg_price
FROM ev GROUP BY category_name"""},
    "top_countries": {"both": """
SELECT country, COUNT(*) AS total_events, COUNT(DISTINCT session_id) AS unique_sessions
FROM ev GROUP BY country ORDER BY total_events DESC, country LIMIT 10"""},
    "daily_volume": {"both": """
SELECT event_date_str AS event_date, COUNT(*) AS total_events FROM ev GROUP BY event_date_str"""},
    "category_share": {"both": """
SELECT category_name, COUNT(*) AS total_events FROM ev GROUP BY category_name"""},
}


def _report(section: str, route: str):
    def run(spark: SparkSession, ev: DataFrame) -> DataFrame:
        store = _store(spark, ev, _REPORT_MARTS.get(section, [])) if route == "mart" else None
        return getattr(Report(ev, store), section)()
    return run


for _section, _routes in _REPORT_ORACLES.items():
    for _route in ("mart", "base"):
        _body = _routes.get(_route, _routes.get("both"))
        _add(f"report_{_section}_{_route}", "clickstream", _report(_section, _route), _body)
_add("report_session_depth", "clickstream", _report("session_depth", "base"),
     QUERIES["session_depth"].plain_sql.replace("{events}", "ev") + "\nLIMIT 20")

# Run everything over events without a price column; priced ones skip
_add("run_all_summary", "clickstream",
     lambda spark, ev: run_all(spark, ev.drop("price"), TableStore(spark, run_dir(spark, "run-all"))),
     """
SELECT * FROM (VALUES
  ('query', 'total_events_by_day', 'ok', (SELECT COUNT(DISTINCT event_date_str) FROM ev)),
  ('query', 'daily_active_users', 'ok', (SELECT COUNT(DISTINCT event_date_str) FROM ev)),
  ('query', 'top_event_types', 'ok', (SELECT COUNT(DISTINCT page_number) FROM ev)),
  ('query', 'top_products', 'skipped', CAST(0 AS BIGINT)),
  ('query', 'revenue_by_category', 'skipped', CAST(0 AS BIGINT)),
  ('query', 'country_device_breakdown', 'skipped', CAST(0 AS BIGINT)),
  ('query', 'hourly_traffic', 'ok', (SELECT COUNT(DISTINCT event_hour) FROM ev)),
  ('query', 'monthly_trends', 'skipped', CAST(0 AS BIGINT)),
  ('query', 'session_depth', 'ok',
     (SELECT COUNT(DISTINCT n) FROM (SELECT COUNT(*) AS n FROM ev GROUP BY session_id) d)),
  ('job', 'event_count_by_type', 'ok', (SELECT COUNT(DISTINCT event_type) FROM ev)),
  ('job', 'country_event_count', 'ok', (SELECT COUNT(DISTINCT country) FROM ev)),
  ('job', 'revenue_by_category', 'skipped', CAST(0 AS BIGINT)),
  ('job', 'total_events_by_day', 'ok', (SELECT COUNT(DISTINCT event_date_str) FROM ev)),
  ('job', 'daily_active_users', 'ok', (SELECT COUNT(DISTINCT event_date_str) FROM ev)),
  ('job', 'top_products', 'ok', (SELECT LEAST(25, COUNT(DISTINCT product_id)) FROM ev)),
  ('job', 'session_depth', 'ok',
     (SELECT COUNT(DISTINCT n) FROM (SELECT COUNT(*) AS n FROM ev GROUP BY session_id) d)))
  t(kind, name, status, "rows")""")
_add("run_all_full", "clickstream",
     lambda spark, ev: run_all(spark, ev, TableStore(spark, run_dir(spark, "run-all"))),
     """
SELECT * FROM (VALUES
  ('query', 'total_events_by_day', 'ok', (SELECT COUNT(DISTINCT event_date_str) FROM ev)),
  ('query', 'daily_active_users', 'ok', (SELECT COUNT(DISTINCT event_date_str) FROM ev)),
  ('query', 'top_event_types', 'ok', (SELECT COUNT(DISTINCT page_number) FROM ev)),
  ('query', 'top_products', 'ok', (SELECT LEAST(25, COUNT(*)) FROM (SELECT DISTINCT product_id, category_name FROM ev) p)),
  ('query', 'revenue_by_category', 'ok', (SELECT COUNT(DISTINCT category_name) FROM ev)),
  ('query', 'country_device_breakdown', 'ok', (SELECT COUNT(DISTINCT country) FROM ev)),
  ('query', 'hourly_traffic', 'ok', (SELECT COUNT(DISTINCT event_hour) FROM ev)),
  ('query', 'monthly_trends', 'ok', (SELECT COUNT(DISTINCT event_month) FROM ev)),
  ('query', 'session_depth', 'ok',
     (SELECT COUNT(DISTINCT n) FROM (SELECT COUNT(*) AS n FROM ev GROUP BY session_id) d)),
  ('job', 'event_count_by_type', 'ok', (SELECT COUNT(DISTINCT event_type) FROM ev)),
  ('job', 'country_event_count', 'ok', (SELECT COUNT(DISTINCT country) FROM ev)),
  ('job', 'revenue_by_category', 'ok', (SELECT COUNT(DISTINCT category_name) FROM ev)),
  ('job', 'total_events_by_day', 'ok', (SELECT COUNT(DISTINCT event_date_str) FROM ev)),
  ('job', 'daily_active_users', 'ok', (SELECT COUNT(DISTINCT event_date_str) FROM ev)),
  ('job', 'top_products', 'ok', (SELECT LEAST(25, COUNT(DISTINCT product_id)) FROM ev)),
  ('job', 'session_depth', 'ok',
     (SELECT COUNT(DISTINCT n) FROM (SELECT COUNT(*) AS n FROM ev GROUP BY session_id) d)))
  t(kind, name, status, "rows")""")

# A report over events without prices leaves two sections out and keeps the others
_add("report_without_price", "clickstream", lambda spark, ev: report_summary(Report(ev.drop("price"))), """
SELECT * FROM (VALUES
  ('overview', 'ok', CAST(1 AS BIGINT)),
  ('first_days', 'ok', (SELECT LEAST(15, COUNT(DISTINCT event_date_str)) FROM ev)),
  ('top_products', 'skipped', CAST(0 AS BIGINT)),
  ('categories', 'skipped', CAST(0 AS BIGINT)),
  ('top_countries', 'ok', (SELECT LEAST(10, COUNT(DISTINCT country)) FROM ev)),
  ('session_depth', 'ok', (SELECT LEAST(20, COUNT(DISTINCT n)) FROM (SELECT COUNT(*) AS n FROM ev GROUP BY session_id) d)),
  ('daily_volume', 'ok', (SELECT COUNT(DISTINCT event_date_str) FROM ev)),
  ('category_share', 'ok', (SELECT COUNT(DISTINCT category_name) FROM ev)))
  t(section, status, "rows")""")


# K7: a store opened anew finds its tables in storage
def _reopened(spark: SparkSession, ev: DataFrame) -> DataFrame:
    root = _store(spark, ev, marts.MART_NAMES).root
    return row_counts(TableStore(spark, root).tables())


_add("store_reopened_row_counts", "clickstream", _reopened, _REG["catalog_row_counts"][2])


# A folder of SQL files
def _sql_folder(spark: SparkSession, ev: DataFrame) -> DataFrame:
    """Files over the events, one with two aliases, back quotes and braces, their results as (query, key, value)."""
    folder = run_dir(spark, "sql")
    texts = {"by_day": "SELECT event_date_str AS key, COUNT(*) AS value\nFROM events\nGROUP BY event_date_str;",
             "by_type": "SELECT event_type AS key, COUNT(DISTINCT session_id) AS value FROM events GROUP BY 1",
             "pairs": "SELECT a.event_type AS key, COUNT(*) AS value FROM events a, `events` b WHERE a.session_id = b.session_id AND a.event_time = b.event_time AND a.event_type <> '{events} FROM events' GROUP BY 1",
             "late": "WITH late AS (SELECT * FROM events WHERE event_hour >= 12)\nSELECT country AS key, COUNT(*) AS value FROM late GROUP BY country"}
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for name, text in texts.items():
        out = fs.create(fs_path(f"{folder}/{name}.sql"))
        out.write(bytearray(text.encode()))
        out.close()
    parts = [df.select(F.lit(name).alias("query"), "key", "value") for name, df in run_sql_folder(spark, ev, folder).items()]
    return reduce(DataFrame.unionAll, parts)


_add("sql_folder_run", "clickstream", _sql_folder, """
SELECT 'by_day' AS query, event_date_str AS key, COUNT(*) AS value FROM ev GROUP BY event_date_str
UNION ALL SELECT 'by_type', event_type, COUNT(DISTINCT session_id) FROM ev GROUP BY event_type
UNION ALL SELECT 'late', country, COUNT(*) FROM ev WHERE event_hour >= 12 GROUP BY country
UNION ALL SELECT 'pairs', a.event_type, COUNT(*) FROM ev a, ev b WHERE a.session_id = b.session_id AND a.event_time = b.event_time GROUP BY 2""")

# A mart whose rebuild fails stays as it was
def _rebuild_failed(spark: SparkSession, ev: DataFrame) -> DataFrame:
    store = _store(spark, ev, ["country_metrics"])
    broken = ev.withColumn("country", F.when(F.col("session_id").isNotNull(), F.raise_error(F.lit("lost")).cast("string")))
    with contextlib.suppress(PySparkException):
        store.write("country_metrics", marts.mart_plans(broken)["country_metrics"])
    return TableStore(spark, store.root).read("country_metrics")


_add("mart_rebuild_failed", "clickstream", _rebuild_failed, """
SELECT country, COUNT(*) AS total_events, COUNT(DISTINCT session_id) AS unique_sessions FROM ev GROUP BY country""")

# Columns and types of a mart read back
_add("mart_schema", "clickstream",
     lambda spark, ev: schema_frame(_store(spark, ev, ["daily_metrics"]).read("daily_metrics")), """
SELECT * FROM (VALUES (0, 'event_date', 'string'), (1, 'total_events', 'bigint'), (2, 'unique_sessions', 'bigint'),
                      (3, 'total_revenue', 'double')) t(position, column_name, type)
WHERE (SELECT COUNT(*) FROM ev) > 0""")

# The order itself, as the place of each row in the result
for _name in ("total_events_by_day", "top_event_types", "revenue_by_category", "top_products", "monthly_trends", "session_depth"):
    _order = {"total_events_by_day": "event_date NULLS LAST", "top_event_types": "total_events DESC, page_position NULLS LAST",
              "revenue_by_category": "total_revenue DESC, category_name NULLS LAST", "top_products": "view_count DESC, product_id NULLS LAST, category_name NULLS LAST",
              "monthly_trends": "event_month", "session_depth": "pages_per_session"}[_name]
    _add(f"order_{_name}", "sales", (lambda n, o: lambda spark, ev: mr.numbered(run_query(spark, ev, n), o))(_name, _order.replace(" NULLS LAST", "")),
         f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_order}) - 1 AS BIGINT) AS place, r.* FROM ({QUERIES[_name].plain_sql.replace('{events}', 'ev')}) r")


# ETL (S1-S2, C1-C4, T1-T16, K1) and the lake (S3, partition pruning): these
# take (spark, sf_dir) directly; the oracle's `ev` is the expected lake content.
_DIRECT: dict[str, tuple[QueryFn, str, str]] = {
    "etl_clickstream": (etl_runs.etl_clickstream, "etl_clickstream", "SELECT * FROM ev"),
    "etl_sales_rerun": (etl_runs.etl_sales_rerun, "etl_sales", "SELECT * FROM ev"),
    "stream_clickstream": (etl_runs.stream_clickstream, "etl_clickstream", "SELECT * FROM ev"),
    "etl_metrics": (etl_runs.etl_clickstream_metrics, "etl_clickstream", """
SELECT CAST(2 * COUNT(*) AS BIGINT) AS rows_read,
       CAST(0 AS BIGINT) AS rows_malformed,
       COUNT(*) AS duplicates_dropped,
       COUNT(*) AS rows_written,
       CAST(0 AS BIGINT) AS rows_without_date,
       COUNT(*) FILTER (event_type = 'error') AS price_filled,
       COUNT(*) FILTER (country = 'unknown') AS country_filled,
       CAST(0 AS BIGINT) AS event_type_filled,
       COUNT(DISTINCT event_date) AS partitions,
       MIN(event_date) AS min_date,
       MAX(event_date) AS max_date
FROM ev"""),
    "etl_separators": (etl_runs.etl_separators, "clickstream", """
SELECT f.file, f.file AS detected, CAST(e.user_id AS VARCHAR) AS session_id, e.event_type,
       e.value AS price, e.props
FROM events e CROSS JOIN (VALUES ('comma'), ('semicolon'), ('tab'), ('pipe')) f(file)"""),
    "lake_daily_active_users_range": (
        lambda spark, sf: etl_runs.lake_days_query(spark, sf, "daily_active_users",
                                                   "2024-01-10", "2024-01-20"),
        "etl_clickstream",
        QUERIES["daily_active_users"].plain_sql.replace(
            "FROM {events}", "FROM ev WHERE event_date_str BETWEEN '2024-01-10' AND '2024-01-20'")),
}
# single ETL steps (C1-C3 + S2 typing, T1, T2-T5, T10-T14)
_DIRECT["etl_map_columns"] = (
    lambda spark, sf: etl_runs.etl_step(spark, sf, "map_columns"), "clickstream_typed",
    "SELECT * FROM ev UNION ALL SELECT * FROM ev")
_DIRECT["etl_drop_duplicates"] = (
    lambda spark, sf: etl_runs.etl_step(spark, sf, "drop_duplicates"), "clickstream_typed",
    "SELECT DISTINCT * FROM ev")
_DIRECT["etl_trim"] = (
    lambda spark, sf: etl_runs.etl_step(spark, sf, "trim"), "clickstream_typed",
    "SELECT session_id, trim(event_type) AS event_type, product_id, country FROM ev")
_DIRECT["etl_derived_columns"] = (
    lambda spark, sf: etl_runs.etl_step(spark, sf, "derived_columns"), "etl_clickstream",
    "SELECT session_id, event_time, event_hour, event_month, day_of_week FROM ev")
_DIRECT["etl_event_time"] = (
    lambda spark, sf: etl_runs.etl_step(spark, sf, "event_time"), "etl_clickstream",
    "SELECT session_id, event_type, event_time, event_date FROM ev")
_DIRECT["etl_fill_missing"] = (
    lambda spark, sf: etl_runs.etl_step(spark, sf, "fill_missing"), "etl_clickstream",
    "SELECT session_id, event_type, country, price, category_id, category_name, event_date_str FROM ev")
_DIRECT["etl_date_parts"] = (etl_runs.etl_date_parts, "sales", """
SELECT CAST(session_id AS VARCHAR) AS session_id, CAST(page_number AS BIGINT) AS event_sequence,
       year(event_time) AS year, month(event_time) AS month, day(event_time) AS day,
       CAST(event_date AS TIMESTAMP) AS event_time, event_date
FROM ev""")
_DIRECT["stream_late_rows"] = (etl_runs.stream_late_rows, "etl_clickstream", "SELECT * FROM ev")
_DIRECT["stream_then_batch"] = (etl_runs.stream_then_batch, "etl_clickstream", "SELECT * FROM ev")
_DIRECT["etl_two_inputs_same_day"] = (etl_runs.etl_two_inputs_same_day, "etl_clickstream", "SELECT * FROM ev")
for _name in marts.MART_NAMES:
    _DIRECT[f"mart_incremental_{_name}"] = (
        (lambda n: lambda spark, sf: etl_runs.mart_incremental(spark, sf, n))(_name), "etl_clickstream", _MART_ORACLES[_name])
_DIRECT["etl_undated_two_inputs"] = (etl_runs.etl_undated_two_inputs, "etl_clickstream", """
SELECT CAST(event_id AS VARCHAR) AS session_id, event_type, CAST(NULL AS TIMESTAMP) AS event_time, CAST(NULL AS VARCHAR) AS event_date_str FROM events""")
_FILE = "SELECT CAST(event_id AS VARCHAR) AS session_id, event_type, value AS price, {props} AS props FROM events"
_DIRECT["etl_mixed_headers"] = (etl_runs.etl_mixed_headers, "etl_clickstream", _FILE.format(props="props"))
_DIRECT["etl_quoted_newlines"] = (etl_runs.etl_quoted_newlines, "etl_clickstream", _FILE.format(props="'first line, \"quoted\"' || chr(10) || props"))
_DIRECT["etl_newlines_mixed_files"] = (etl_runs.etl_newlines_mixed_files, "etl_clickstream", _FILE.format(props="CASE WHEN event_id % 3 = 0 THEN 'first line, \"quoted\"' || chr(10) ELSE '' END || props"))
_DIRECT["etl_quoted_values"] = (etl_runs.etl_quoted_values, "etl_clickstream", """
SELECT CAST(event_id AS VARCHAR) AS session_id, event_type, value AS price,
       CASE event_id % 4 WHEN 0 THEN event_type || ' 55"' WHEN 1 THEN '"' || event_type || '"' WHEN 2 THEN '"' ELSE 'say "' || event_type || '" twice' END AS note
FROM events""")
_DIRECT["etl_rerun_shrunk"] = (etl_runs.etl_rerun_shrunk, "etl_clickstream", """
SELECT mode, CAST(event_id AS VARCHAR) AS session_id, strftime(ts, '%Y-%m-%d') AS event_date_str
FROM events, (VALUES ('static'), ('dynamic')) m(mode) WHERE CAST(ts AS DATE) > (SELECT MIN(CAST(ts AS DATE)) FROM events)""")
_LINE = "CAST(event_id AS VARCHAR) || ',' || event_type || ',' || CAST(value AS VARCHAR)"
_DIRECT["etl_malformed_rows"] = (etl_runs.etl_malformed_rows, "etl_clickstream", f"""
SELECT 'loaded' AS place, CAST(event_id AS VARCHAR) AS content, value AS price FROM events WHERE event_id % 10 NOT IN (1, 2, 3)
UNION ALL SELECT 'quarantine', CASE event_id % 10 WHEN 1 THEN {_LINE} || ',extra' WHEN 2 THEN CAST(event_id AS VARCHAR) || ',' || event_type
                 ELSE CAST(event_id AS VARCHAR) || ',cut",' || CAST(value AS VARCHAR) END, NULL FROM events WHERE event_id % 10 IN (1, 2, 3)
UNION ALL SELECT 'counted', CAST(COUNT(*) AS VARCHAR), NULL FROM events WHERE event_id % 10 IN (1, 2, 3)""")
_DIRECT["etl_ids_with_gap"] = (etl_runs.etl_ids_with_gap, "etl_clickstream", """
SELECT CASE WHEN event_id % 10 <> 0 THEN CAST(event_id + 9007199254740992 AS VARCHAR) END AS session_id,
       CASE WHEN event_id % 7 <> 0 THEN event_id + 9007199254740992 END AS event_sequence, CAST(event_id AS VARCHAR) AS row FROM events""")
_DIRECT["etl_type_drift"] = (etl_runs.etl_type_drift, "etl_clickstream", """
SELECT CASE WHEN event_id % 2 = 0 THEN '' ELSE 'A' END || CAST(event_id AS VARCHAR) AS session_id,
       CAST(user_id AS VARCHAR) || CASE WHEN event_id % 2 = 0 THEN '' ELSE 'x' END AS extra, value AS price FROM events""")
_DIRECT["etl_event_time_zone"] = (etl_runs.etl_event_time_zone, "etl_clickstream", """
SELECT CAST(event_id AS VARCHAR) AS session_id, TIMESTAMP '2008-03-09 02:00:00' + (event_id % 60) * INTERVAL 1 MINUTE AS event_time,
       CAST(2 AS INTEGER) AS event_hour, '2008-03-09' AS event_date_str FROM events""")
_DIRECT["etl_bare_date"] = (etl_runs.etl_bare_date, "etl_clickstream", """
SELECT CAST(event_id AS VARCHAR) AS session_id, CAST(d AS TIMESTAMP) AS event_time, d AS event_date, CAST(hour(CAST(d AS TIMESTAMP)) AS INTEGER) AS event_hour,
       strftime(d, '%Y-%m') AS event_month, dayname(d) AS day_of_week
FROM (SELECT event_id, CASE WHEN event_id % 4 <> 3 THEN CAST(ts AS DATE) END AS d FROM events) e""")
_DIRECT["etl_schema_report"] = (etl_runs.etl_schema_report, "clickstream_typed", """
SELECT column_name, required, present, type, CAST(n AS BIGINT) AS non_null_rows FROM (VALUES
  ('session_id', true, true, 'string', (SELECT 2 * COUNT(session_id) FROM ev)),
  ('price', false, true, 'double', (SELECT 2 * COUNT(price) FROM ev)),
  ('country', false, true, 'string', (SELECT 2 * COUNT(country) FROM ev)),
  ('product_id', false, true, 'string', (SELECT 2 * COUNT(product_id) FROM ev)),
  ('category_id', false, true, 'double', (SELECT 2 * COUNT(category_id) FROM ev)),
  ('device', false, false, NULL, 0),
  ('event_type', false, true, 'string', (SELECT 2 * COUNT(event_type) FROM ev))) t(column_name, required, present, type, n)""")
for _name in ("revenue_by_category", "top_products", "session_depth", "monthly_trends"):
    _DIRECT[f"lake_{_name}"] = (
        (lambda n: lambda spark, sf: etl_runs.lake_days_query(spark, sf, n))(_name),
        "etl_clickstream", QUERIES[_name].plain_sql.replace("{events}", "ev"))


def _bind(adapter: str, fn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, ADAPTERS[adapter](spark, sf_dir))
    return run


# The text operators live in a subpackage of their own, which may be absent, or lack a library here.
_LLM, _LLM_SQL = {}, {}
with contextlib.suppress(ImportError):
    from eventmart.llm import registry as _llm
    _LLM.update(_llm.QUERIES)
    _LLM_SQL.update(_llm.SQL)
with contextlib.suppress(ImportError):
    import corpus_pipeline as _pipeline
    _LLM["pipeline"] = _pipeline.run
    if _pipeline.ORACLE_SQL is not None:
        _LLM_SQL["pipeline"] = _pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: revenue by category over the clickstream events at sf0.001."""
    return run_query(spark, ADAPTERS["clickstream"](spark, FLAGSHIP_SF), "revenue_by_category")


def queries() -> dict[str, QueryFn]:
    out = {key: _bind(adapter, fn) for key, (adapter, fn, _) in _REG.items()}
    out.update({key: fn for key, (fn, _, _) in _DIRECT.items()})
    return out | _LLM


def oracle_sql() -> dict[str, str]:
    out = {key: oracle.with_ev(adapter, body)
           for key, (adapter, _, body) in _REG.items() if body is not None}
    out.update({key: oracle.with_ev(ev, body) for key, (_, ev, body) in _DIRECT.items()})
    return out | _LLM_SQL
