"""Command line: ``python -m eventmart <command> ...``

  etl          delimited event file(s) -> day-partitioned lake
  ingest       new files of a landing folder -> lake (incremental, exactly once)
  build-marts  lake -> aggregate tables in a table store, with row counts
  query        one named SQL query (or all of them) over the lake
  job          one analytics job (or all of them) over the lake
  sql          every .sql file of a folder over the lake
  report       the analysis report (from marts when the store has them)
  tables       the tables of a store, with row counts

Paths are whatever Spark can read and write (shared storage on a cluster).
Results are shown with ``show`` (a bounded preview); ``--csv`` writes them whole.
"""

from __future__ import annotations

import argparse
import sys

from eventmart.operators import jobs, marts
from eventmart.operators.etl import run_etl
from eventmart.operators.mart_states import update_marts
from eventmart.operators.report import Report
from eventmart.operators.sinks import read_csv, row_counts, write_csv_if_any
from eventmart.plans.queries import QUERIES, run_query, run_sql_folder
from eventmart.plans.run_all import run_all
from eventmart.session import build_session
from eventmart.sources.lake import TableStore, read_lake
from eventmart.streaming.ingest import start_ingest


def _input_options(s: argparse.ArgumentParser) -> None:
    s.add_argument("--sep", default=None, help="default: found in each file's header")
    s.add_argument("--quarantine", default=None, help="folder for malformed rows (default: they stop the run)")
    s.add_argument("--multi-line", action="store_true", help="read line breaks inside quotes in all files (default: in those that have some)")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="eventmart")
    p.add_argument("--master", default=None, help="Spark master (default: spark-submit's, else local[BENCH_CPUS|8])")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("etl")
    s.add_argument("--input", required=True)
    s.add_argument("--lake", required=True)
    _input_options(s)
    s.add_argument("--source", default=None, help="name of the input; a rerun replaces its rows (default: from the path)")

    s = sub.add_parser("ingest")
    s.add_argument("--landing", required=True)
    s.add_argument("--lake", required=True)
    s.add_argument("--checkpoint", required=True)
    _input_options(s)

    s = sub.add_parser("build-marts")
    s.add_argument("--lake", required=True)
    s.add_argument("--store", required=True)
    s.add_argument("--incremental", action="store_true", help="read only inputs that changed since the store's last incremental build")

    for name, choices in (("query", sorted(QUERIES)), ("job", sorted(jobs.JOBS))):
        s = sub.add_parser(name)
        s.add_argument("--lake", required=True)
        s.add_argument("--name", choices=choices, default=None, help="default: all")
        s.add_argument("--show", type=int, default=10)
        s.add_argument("--csv", default=None, help="folder for result CSVs")
        s.add_argument("--store", default=None, help="table store for results")

    s = sub.add_parser("sql")
    s.add_argument("--lake", required=True)
    s.add_argument("--folder", required=True, help="folder of .sql files that read the table events")
    s.add_argument("--show", type=int, default=10)
    s.add_argument("--csv", default=None, help="folder for result CSVs")

    s = sub.add_parser("report")
    s.add_argument("--lake", required=True)
    s.add_argument("--store", default=None)
    s.add_argument("--show", type=int, default=20)
    s.add_argument("--csv", default=None, help="folder for the sections, whole")

    s = sub.add_parser("tables")
    s.add_argument("--store", required=True)
    return p


def _put(spark, df, name: str, csv: str | None, show: int) -> None:
    """Write a result whole, if a folder is given, and show its first rows, from what was written."""
    if csv and write_csv_if_any(df, path := f"{csv.rstrip('/')}/{name}"):
        df = read_csv(spark, path, df.schema)
    df.show(show, truncate=False)


def main(argv=None, spark=None) -> int:
    """Run one command; with ``spark`` given, use (and keep) that session."""
    args = _parser().parse_args(argv)
    own = spark is None
    spark = spark or build_session(master=args.master)
    if args.cmd == "etl":
        res = run_etl(spark, args.input, args.lake, source=args.source, sep=args.sep, quarantine=args.quarantine, multi_line=args.multi_line or None)
        print(f"source {res.source}; missing optional columns {res.missing_optional}")
        for x in res.layouts:
            print(f"separator {x.sep!r}, {len(x.header)} columns: {len(x.files)} file(s)")
        for k, v in res.metrics.items():
            print(f"{k:>20}: {v}")
    elif args.cmd == "ingest":
        start_ingest(spark, args.landing, args.lake, args.checkpoint, sep=args.sep, quarantine=args.quarantine,
                     multi_line=args.multi_line or None).awaitTermination()
    elif args.cmd == "build-marts":
        store = TableStore(spark, args.store)
        built = update_marts(store, args.lake)[0] if args.incremental else marts.build_marts(store, read_lake(spark, args.lake))
        row_counts(built).show(truncate=False)
    elif args.cmd in ("query", "job"):
        events = read_lake(spark, args.lake)
        store = TableStore(spark, args.store) if args.store else None
        if args.name is None:
            run_all(spark, events, store, args.csv, kind=args.cmd).show(100, truncate=False)
        else:
            df = run_query(spark, events, args.name) if args.cmd == "query" \
                else jobs.run_job(args.name, events)
            if store is not None:
                df = store.write(args.name if args.cmd == "query" else f"mr_{args.name}", df)
            _put(spark, df, args.name, args.csv, args.show)
    elif args.cmd == "sql":
        for name, df in run_sql_folder(spark, read_lake(spark, args.lake), args.folder).items():
            print(f"== {name}")
            _put(spark, df, name, args.csv, args.show)
    elif args.cmd == "report":
        report = Report(read_lake(spark, args.lake), TableStore(spark, args.store) if args.store else None)
        made = report.sections()
        for name in report.available():
            print(f"== {name}" + (" (skipped: its columns are absent)" if name not in made else ""))
            if name in made:
                _put(spark, made[name], name, args.csv, args.show)
    elif args.cmd == "tables":
        row_counts(TableStore(spark, args.store).tables()).show(1000, truncate=False)
    if own:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
