"""ETL: delimited event files -> canonical, cleaned events -> day-partitioned lake.

``run_etl`` chains the steps below into one lazy plan and one write:

  scan (text) -> map columns -> validate -> declared types -> drop duplicate rows
  -> trim text -> event time/date -> derived columns -> fill missing -> write

Two steps shuffle: the duplicate drop (a hash aggregate on all columns, partially
aggregated in every map task, so a row repeated a billion times costs one row
per task) and the write, which is rebalanced by day before most columns are derived.  Metrics are collected with
``DataFrame.observe`` during the write itself.

The typed rows of a large input are staged first, by slices of days (copies of a row have the same day), and slice after slice is then
cleaned and written to the same version.  So the disk holds the shuffled rows of one slice, not of the whole input twice.

The write is a version that counts only when it is whole (``sources.snapshots``).  Malformed rows (see ``sources.delimited``) stop
the run before it is committed, unless a ``quarantine`` folder is given: they are then written there with their text, and counted, before
the commit.  If there are any, files with line breaks inside quotes are looked for, and the input is read again with those as a whole.

Deliberate differences from a pandas implementation of the same steps:
missing text stays null rather than the text ``nan`` and is then filled with
``unknown``; a missing time leaves ``event_month``/``event_date_str`` null (not
``NaT``); a bare ``date`` column is parsed (not overwritten with nulls); column types are
declared, not guessed from the data; a rerun of an input replaces its own rows instead of adding copies.
"""

from __future__ import annotations

import contextlib
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.expressions import as_double, category_label
from eventmart.functions.naming import OPTIONAL_COLUMNS, REQUIRED_COLUMNS, column_plan
from eventmart.session import run_dir
from eventmart.sources import delimited
from eventmart.sources.delimited import BAD_ROW, Layout
from eventmart.sources.lake import PARTITION_COLUMN, checked_source, deal_by_day, lake_snapshots, source_folder, write_days

# Columns whose missing numbers become 0, and whose missing labels become "unknown".
PRICE_COLUMNS = ["price", "price_secondary"]
LABEL_COLUMNS = ["country", "device", "event_type", "colour", "location"]

#: An input of so many bytes, as stored, is staged.
STAGED_FROM = 64 << 20
#: Slices of days that staged rows are dealt out to; small ones are handled together, up to so many staged bytes.
SLICES = 16
SLICE_BYTES = 128 << 20
SLICE_COLUMN = "_slice"

#: Names of the days from Monday on, as ``EEEE`` formats them.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

#: Date layouts besides ISO, as (pattern, ISO form): year first, month first with slashes, day first with points.
DATE_LAYOUTS = [
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2"),
    (r"^(\d{1,2})\.(\d{1,2})\.(\d{4})", "$3-$2-$1"),
]


class SchemaError(ValueError):
    """A required column is missing after header mapping."""


class MalformedRows(PySparkException, ValueError):
    """An input has rows that do not fit their header."""


# -- schema ----------------------------------------------------------------

def validate_schema(columns) -> list[str]:
    """Raise if a required column is missing; return missing optional columns."""
    missing = [c for c in REQUIRED_COLUMNS if c not in columns]
    if missing:
        raise SchemaError(f"missing required columns: {missing}")
    return [c for c in OPTIONAL_COLUMNS if c not in columns]


def column_profile(df: DataFrame) -> DataFrame:
    """``(column_name, present, non_null_rows, purpose)`` per optional column,
    from one aggregate over ``df``."""
    present = [c for c in OPTIONAL_COLUMNS if c in df.columns]
    counts = df.agg(*[F.count(c).alias(c) for c in present], F.count(F.lit(1)).alias("__rows"))
    stack = ", ".join(
        f"'{c}', {'true' if c in present else 'false'}, "
        f"{f'`{c}`' if c in present else 'CAST(0 AS BIGINT)'}, '{p}'"
        for c, p in OPTIONAL_COLUMNS.items())
    return counts.selectExpr(
        f"stack({len(OPTIONAL_COLUMNS)}, {stack}) AS (column_name, present, non_null_rows, purpose)")


def schema_report(df: DataFrame) -> DataFrame:
    """``(column_name, required, present, type, non_null_rows)`` of the required and optional columns, from one aggregate."""
    types, wanted = dict(df.dtypes), [*REQUIRED_COLUMNS, *OPTIONAL_COLUMNS]
    counts = df.agg(*[F.count(c).alias(c) for c in wanted if c in types])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(c in REQUIRED_COLUMNS).alias("required"), F.lit(c in types).alias("present"),
                     F.lit(types.get(c)).cast("string").alias("type"), (F.col(c) if c in types else F.lit(0).cast("bigint")).alias("non_null_rows"))
            for c in wanted]
    return counts.select(F.inline(F.array(*rows)))


# -- cleaning --------------------------------------------------------------

def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def trim_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.trim(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def _parse_timestamp(c) -> F.Column:
    """Text -> time as written; no time zone is involved."""
    text = F.trim(F.col(c).cast("string"))
    for pattern, iso in DATE_LAYOUTS:
        text = F.regexp_replace(text, pattern, iso)
    return text.try_cast("timestamp_ntz")


def _whole_number(df: DataFrame, c: str) -> F.Column:
    v = as_double(df, c)
    return F.when(v == F.floor(v), v.try_cast("bigint"))


def _date_of(year: F.Column, month: F.Column, day: F.Column) -> F.Column:
    """The date that ``yyyy-MM-dd`` of three whole numbers reads as, or null.  Usual numbers take no way over text, which costs ten times as much."""
    usual = year.between(1, 9999) & month.between(1, 12) & day.between(1, 31)
    first = F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
    date = F.when(day <= F.dayofmonth(F.last_day(first)), F.date_add(first, (day - 1).cast("int")))
    return F.when(usual, date).otherwise(F.format_string("%04d-%02d-%02d", year, month, day).try_cast("date"))


def event_time_columns(df: DataFrame) -> tuple:
    """``(event_time, event_date)`` expressions from the first of: an event_time
    column; year/month/day columns (midnight); a date column; else nulls."""
    cols = set(df.columns)
    if "event_time" in cols:
        ts = _parse_timestamp("event_time")
        return ts, F.to_date(ts)
    if {"year", "month", "day"} <= cols:
        d = _date_of(*[_whole_number(df, c) for c in ("year", "month", "day")])
        return d.cast("timestamp_ntz"), d
    if "event_date" in cols:
        d = F.to_date(_parse_timestamp("event_date"))
        return d.cast("timestamp_ntz"), d
    return F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("date")


def build_event_datetime(df: DataFrame) -> DataFrame:
    ts, d = event_time_columns(df)
    return df.withColumns({"event_time": ts, "event_date": d})


def add_derived_columns(df: DataFrame) -> DataFrame:
    day = F.to_date("event_time")
    new = {
        "event_hour": F.hour("event_time").cast("int"),
        "event_month": F.substring(day.cast("string"), 1, 7),
        "day_of_week": F.get(F.array(*map(F.lit, WEEKDAYS)), F.weekday(day)),
    }
    if "category_id" in df.columns:
        cid = as_double(df, "category_id")
        new["category_id"] = cid
        new["category_name"] = category_label(cid)
    for c in PRICE_COLUMNS:
        if c in df.columns:
            new[c] = as_double(df, c)
    return df.withColumns(new)


def fill_missing(df: DataFrame) -> DataFrame:
    new = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in PRICE_COLUMNS if c in df.columns}
    new.update({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
                for c in LABEL_COLUMNS if c in df.columns})
    return df.withColumns(new)


def add_partition_key(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, F.col("event_date").cast("string"))


def clean_events(df: DataFrame) -> DataFrame:
    """Typed, canonically named rows -> canonical events (lazy)."""
    return (df.transform(drop_duplicate_rows)
              .transform(trim_text)
              .transform(build_event_datetime)
              .transform(add_derived_columns)
              .transform(fill_missing)
              .transform(add_partition_key))


# -- whole pipeline ----------------------------------------------------------

@dataclass
class EtlResult:
    output_path: str
    source: str
    layouts: list[Layout]
    missing_optional: list[str]
    metrics: dict = field(default_factory=dict)

    @property
    def separator(self) -> str:
        """The separator, where all files have the same."""
        (sep,) = {x.sep for x in self.layouts}
        return sep


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def source_name(spark: SparkSession, paths) -> str:
    """Source id of an input by its paths, however they are spelled: the last name, readable, and a digest of them all."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    qualified = [p.getFileSystem(conf).makeQualified(p).toString() for p in map(path, _paths(paths))]
    paths = sorted(qualified)
    name = re.sub(r"[^A-Za-z0-9]+", "-", paths[0].rstrip("/").rsplit("/", 1)[-1]).strip("-")
    return f"{name[:40]}-{hashlib.sha256(chr(10).join(paths).encode()).hexdigest()[:12]}"


def read_events_file(spark: SparkSession, paths, sep: str | None = None, multi_line: bool = False):
    """Scan, map, validate and type an input.  Returns (typed frame with ``BAD_ROW``, layouts, missing optional columns)."""
    found = delimited.layouts(spark, _paths(paths), sep)
    for x in found:
        validate_schema([c for _, c in column_plan(list(x.header))])
    typed = delimited.read_layouts(spark, found, multi_line)
    return typed, found, validate_schema(typed.columns)


def well_formed(typed: DataFrame, fail: bool = True) -> DataFrame:
    """The rows that fit their header; another row fails the job, or is left out."""
    bad = F.col(BAD_ROW).isNotNull()
    if fail:
        stop = F.raise_error(F.concat(F.lit("malformed row: "), F.col(BAD_ROW))).cast("boolean")
        return typed.filter(F.when(bad, stop).otherwise(F.lit(True))).drop(BAD_ROW)
    return typed.filter(~bad).drop(BAD_ROW)


def _is_large(spark: SparkSession, found: list[Layout]) -> bool:
    """Whether the input's files have ``STAGED_FROM`` bytes."""
    path, conf, size = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), 0
    for at in (path(f) for x in found for f in x.files):
        fs = at.getFileSystem(conf)
        size += sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(at) or ())
        if size >= STAGED_FROM:
            return True
    return False


def _together(sizes: dict[str, int], most: int) -> list[list[str]]:
    """The names in lists of up to ``most`` bytes; a larger one stands alone."""
    lists, room = [], 0
    for name, size in sizes.items():
        if not lists or size > room:
            lists.append([])
            room = most
        lists[-1].append(name)
        room -= size
    return lists


def _staged(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows in parts, each with all rows of its days; a part's files are deleted when the next is asked for."""
    spark = rows.sparkSession
    folder = run_dir(spark, "staged")
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        day = event_time_columns(rows)[1]
        write_days(rows.withColumn(SLICE_COLUMN, F.pmod(F.hash(day), F.lit(SLICES))), folder, SLICE_COLUMN, compression="zstd")
        slices = [s.getPath() for s in fs.listStatus(at) if s.isDirectory()]
        sizes = {p.toString(): fs.getContentSummary(p).getLength() for p in slices}
        for names in _together(sizes, SLICE_BYTES) or [[]]:
            yield spark.read.schema(rows.schema).parquet(*names) if names else spark.createDataFrame([], rows.schema)
            for name in names:
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(name), True)
    finally:
        fs.delete(at, True)


def _write_part(rows: DataFrame, folder: str) -> dict:
    """Clean well-formed rows and add them to a version's folder.  Returns metrics."""
    timed = rows.transform(drop_duplicate_rows).transform(trim_text).transform(build_event_datetime)
    derived = deal_by_day(timed, "event_date").transform(add_derived_columns)
    fill_obs = Observation("filled")
    derived = derived.observe(
        fill_obs, F.lit(0).alias("_"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_filled")
          for c in PRICE_COLUMNS + LABEL_COLUMNS if c in derived.columns])
    out_obs = Observation("rows_written")
    events = (derived.transform(fill_missing).transform(add_partition_key)
              .observe(out_obs,
                       F.count(F.lit(1)).alias("rows_written"),
                       F.min("event_date").alias("min_date"),
                       F.max("event_date").alias("max_date"),
                       F.count_if(F.col("event_date").isNull()).alias("rows_without_date")))
    write_days(events, folder)
    return {**{k: v for k, v in fill_obs.get.items() if k != "_"}, **out_obs.get}


def _merged(parts: list[dict]) -> dict:
    """Metrics of all parts: counts are added up."""
    how = {"min_date": min, "max_date": max}
    return {k: how.get(k, sum)([p[k] for p in parts if p[k] is not None] or [None]) for k in parts[0]}


def _write_events(typed: DataFrame, output_path: str, source: str, staged: bool) -> tuple[str, dict]:
    """Clean the well-formed rows and write them as a version of the source, not committed.  Returns version and metrics."""
    read_obs = Observation("rows_read")
    typed = typed.observe(read_obs, F.count(F.lit(1)).alias("rows_read"), F.count(BAD_ROW).alias("rows_malformed"), F.min(BAD_ROW).alias("example"))
    rows = well_formed(typed, fail=False)
    log = lake_snapshots(typed.sparkSession, output_path)
    version = log.begin()
    folder = log.folder(checked_source(source), version)
    try:
        with contextlib.closing(_staged(rows) if staged else (x for x in [rows])) as parts:
            written = _merged([_write_part(part, folder) for part in parts])
    except BaseException:
        log.abandon(source, version)
        raise
    metrics = {**read_obs.get, **written}
    metrics["duplicates_dropped"] = metrics["rows_read"] - metrics["rows_malformed"] - metrics["rows_written"]
    return version, metrics


def run_etl(spark: SparkSession, input_path, output_path: str, *, source: str | None = None, sep: str | None = None,
            quarantine: str | None = None, multi_line: bool | None = None) -> EtlResult:
    """Add an input (a path or several) to a lake.  ``source`` names it; a rerun under the same name replaces
    its rows, in one step.  Malformed rows go to ``quarantine``, or fail the run.

    ``multi_line``: quoted fields may hold line breaks in all files (True) or in none (False); by default in those files where
    they do."""
    source = source or source_name(spark, input_path)
    log = lake_snapshots(spark, output_path)
    typed, found, missing = read_events_file(spark, input_path, sep, bool(multi_line))
    staged = _is_large(spark, found)
    version, metrics = _write_events(typed, output_path, source, staged)
    if metrics["rows_malformed"] and multi_line is None:
        found = [delimited.files_with_breaks(spark, x) for x in found]
        if any(x.whole for x in found):
            log.abandon(source, version)
            typed = delimited.read_layouts(spark, found)
            version, metrics = _write_events(typed, output_path, source, staged)
    example = metrics.pop("example")
    if metrics["rows_malformed"]:
        if quarantine is None:
            log.abandon(source, version)
            raise MalformedRows(f"malformed row: {example}")
        (typed.filter(F.col(BAD_ROW).isNotNull()).select(F.col(BAD_ROW).alias("line"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(source_folder(quarantine, source)))
    log.commit(source, version)
    return EtlResult(output_path, source, found, missing, metrics)


def etl_metrics_frame(spark: SparkSession, result: EtlResult) -> DataFrame:
    """The run's metrics as one row; its days are counted in the folder it wrote."""
    m = result.metrics
    days = spark.read.parquet(lake_snapshots(spark, result.output_path).current(result.source)).agg(
        F.count_distinct(PARTITION_COLUMN).alias("partitions"))
    counted = [k for k in m if k in ("rows_read", "rows_malformed", "duplicates_dropped", "rows_written", "rows_without_date") or k.endswith("_filled")]
    return days.select(
        *[F.lit(m[k]).cast("bigint").alias(k) for k in counted],
        F.col("partitions"),
        F.lit(m["min_date"]).cast("date").alias("min_date"),
        F.lit(m["max_date"]).cast("date").alias("max_date"),
    )
