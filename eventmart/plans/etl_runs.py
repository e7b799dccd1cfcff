"""End-to-end ETL runs over raw files that Spark derives from the benchmark tables.

Each run exports a whole table as a delimited file with raw-style headers
(aliases, padding, alias collisions, an unmapped header), missing-value tokens
and text padding, then ingests it with ``run_etl`` into a day-partitioned lake
under the shared work folder, and reads the lake back.  The expected rows are
therefore a plain function of the source table (see the oracles).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators.etl import (
    add_derived_columns, build_event_datetime, clean_events, drop_duplicate_rows,
    etl_metrics_frame, read_events_file, run_etl, schema_report, trim_text, well_formed,
)
from eventmart.operators.mart_states import update_marts
from eventmart.plans.queries import run_query
from eventmart.session import run_dir
from eventmart.sources.lake import PARTITION_COLUMN, TableStore, days_between, read_lake
from eventmart.sources.tables import table
from eventmart.streaming.ingest import start_ingest


#: Records of an exported file: compressed files cannot be cut, so they are read several a task.
RECORDS_PER_FILE = 500_000


def export_delimited(df: DataFrame, path: str, sep: str, mode: str = "overwrite") -> None:
    """Write ``df`` as delimited text with a header, compressed, keeping values verbatim
    (no whitespace stripping; embedded quotes doubled).  ``append`` adds new
    files next to the ones already in ``path``."""
    (df.write.mode(mode)
       .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
       .option("header", True).option("sep", sep)
       .option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def clickstream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a raw click log.  Every row appears twice (exact copies)."""
    src = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"([0-9]+)", 1)
    raw = src.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp"),
        F.col("user_id").alias("Session ID"),
        F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")).alias("Action"),
        (F.col("event_id") % 5 + 1).alias("Page"),
        (k.try_cast("int") % 5).alias("Page 1 (main category)"),
        F.concat(F.lit("P"), k).alias("Page 2 (clothing model)"),
        F.when(F.col("user_id") % 30 == 0, F.lit("NA"))
         .otherwise(F.concat(F.lit("C"), (F.col("user_id") % 30).cast("string"))).alias("Country"),
        F.when(F.col("event_type") == "error", F.lit("n/a"))
         .otherwise(F.col("value").cast("string")).alias("Price"),
        (F.col("value") * 2).alias("Revenue"),
        F.col("props").alias("Extra Col!"),
    )
    return raw.unionAll(raw)


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a raw sales log with separate year / month / day fields."""
    src = table(spark, sf_dir, "lineitem")
    return src.select(
        F.year("l_shipdate").alias("Year"),
        F.month("l_shipdate").alias("Month"),
        F.dayofmonth("l_shipdate").alias(" DAY "),
        F.col("l_orderkey").alias("Session ID"),
        F.col("l_linenumber").alias("Order"),
        (F.col("l_partkey") % 5).alias("Category"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("Clothing_Model"),
        F.col("l_extendedprice").alias("Amount"),
        F.col("l_tax").alias("Price 2"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 25).cast("string")).alias("Country"),
        F.when(F.col("l_linestatus") == "O", F.lit("mobile")).alias("Device"),
        F.col("l_returnflag").alias("Action"),
    )


CLICKSTREAM_COLUMNS = [
    "session_id", "event_time", "event_date", "event_date_str", "event_hour", "event_month",
    "day_of_week", "event_type", "page_number", "category_id", "category_name", "product_id",
    "country", "price", "extra_col",
]
SALES_COLUMNS = [
    "session_id", "event_time", "event_date", "event_date_str", "event_hour", "event_month",
    "day_of_week", "event_sequence", "event_type", "category_id", "category_name", "product_id",
    "price", "price_secondary", "country", "device",
]


def _clickstream_lake(spark: SparkSession, sf_dir: str):
    work = run_dir(spark, "etl-clickstream")
    export_delimited(clickstream_raw(spark, sf_dir), f"{work}/raw", ",")
    result = run_etl(spark, f"{work}/raw", f"{work}/lake")
    return result, read_lake(spark, result.output_path)


def etl_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lake = _clickstream_lake(spark, sf_dir)
    return lake.select(*CLICKSTREAM_COLUMNS)


def etl_clickstream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    result, _ = _clickstream_lake(spark, sf_dir)
    return etl_metrics_frame(spark, result)


def etl_sales_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales file ingested twice into one lake: the second run replaces its own
    rows, so the lake holds each row once."""
    work = run_dir(spark, "etl-sales")
    export_delimited(sales_raw(spark, sf_dir), f"{work}/raw", ";")
    run_etl(spark, f"{work}/raw", f"{work}/lake")
    run_etl(spark, f"{work}/raw", f"{work}/lake")
    return read_lake(spark, f"{work}/lake").select(*SALES_COLUMNS)


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The clickstream export before and from the middle of its time range."""
    bounds = table(spark, sf_dir, "events").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    raw = clickstream_raw(spark, sf_dir)
    if bounds.lo is None:
        return raw, raw.limit(0)
    split = bounds.lo + (bounds.hi - bounds.lo) / 2
    early = F.col("Timestamp") < F.lit(split.strftime("%Y-%m-%d %H:%M:%S.%f"))
    return raw.filter(early), raw.filter(~early)


def _streamed(spark: SparkSession, parts, work: str) -> None:
    """Each part lands and is ingested by one incremental run."""
    for i, part in enumerate(parts):
        export_delimited(part, f"{work}/landing", ",", mode="overwrite" if i == 0 else "append")
        start_ingest(spark, f"{work}/landing", f"{work}/lake", f"{work}/checkpoint").awaitTermination()


def stream_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clickstream export landing in two arrivals, each ingested by one incremental streaming
    run into the same lake.  The second run reads only the new files.  The lake must equal the batch ETL's."""
    work = run_dir(spark, "stream-clickstream")
    _streamed(spark, _halves(spark, sf_dir), work)
    return read_lake(spark, f"{work}/lake").select(*CLICKSTREAM_COLUMNS)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half arrives first: every row of the second arrival is late, by two weeks, and none is lost."""
    work = run_dir(spark, "stream-late")
    _streamed(spark, reversed(_halves(spark, sf_dir)), work)
    return read_lake(spark, f"{work}/lake").select(*CLICKSTREAM_COLUMNS)


def stream_then_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half streamed, the other added by the batch ETL to the same lake."""
    work = run_dir(spark, "stream-batch")
    early, late = _halves(spark, sf_dir)
    _streamed(spark, [early], work)
    export_delimited(late, f"{work}/raw", ",")
    run_etl(spark, f"{work}/raw", f"{work}/lake")
    return read_lake(spark, f"{work}/lake").select(*CLICKSTREAM_COLUMNS)


def etl_two_inputs_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of all days split over two inputs of one lake, by event number: each adds its rows to every day."""
    work = run_dir(spark, "etl-two")
    raw = clickstream_raw(spark, sf_dir)
    for name, part in (("even", raw.filter("Page % 2 = 0")), ("odd", raw.filter("Page % 2 <> 0"))):
        export_delimited(part, f"{work}/{name}", ",")
        run_etl(spark, f"{work}/{name}", f"{work}/lake")
    return read_lake(spark, f"{work}/lake").select(*CLICKSTREAM_COLUMNS)


def mart_incremental(spark: SparkSession, sf_dir: str, mart: str) -> DataFrame:
    """A mart brought up to date after each of three runs: an input with all events, another with some of them, and the first again without those."""
    work = run_dir(spark, "marts-incremental")
    raw = clickstream_raw(spark, sf_dir)
    store, lake = TableStore(spark, f"{work}/marts"), f"{work}/lake"
    some, others = raw.filter("Page % 3 = 0"), raw.filter("Page % 3 <> 0")
    for name, part in (("first", raw), ("second", some), ("first", others)):
        export_delimited(part, f"{work}/{name}", ",")
        run_etl(spark, f"{work}/{name}", lake)
        marts, _ = update_marts(store, lake)
    return marts[mart]


def etl_undated_two_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inputs without any readable time, one run twice: their undated rows stand side by side."""
    work = run_dir(spark, "etl-undated")
    raw = table(spark, sf_dir, "events").select(F.col("event_id").alias("Session ID"), F.lit("no time").alias("Timestamp"), F.col("event_type").alias("Action"))
    for name, part in (("even", raw.filter("`Session ID` % 2 = 0")), ("odd", raw.filter("`Session ID` % 2 <> 0")), ("even", raw.filter("`Session ID` % 2 = 0"))):
        export_delimited(part, f"{work}/{name}", ",")
        run_etl(spark, f"{work}/{name}", f"{work}/lake")
    return read_lake(spark, f"{work}/lake").select("session_id", "event_type", "event_time", PARTITION_COLUMN)


def _events_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("Session ID"), F.col("event_type").alias("Action"), F.col("value").alias("Price"), F.col("props").alias("Props"))


_FILE_COLUMNS = ["session_id", "event_type", "price", "props"]


def etl_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder, two files: other order of columns, other names for them, another separator."""
    work = run_dir(spark, "etl-mixed")
    raw = _events_file(spark, sf_dir)
    export_delimited(raw.filter("`Session ID` % 2 = 0"), f"{work}/raw/a", ",")
    other = raw.filter("`Session ID` % 2 <> 0").select("Props", F.col("Price").alias("amount"), F.col("Session ID").alias("SessionId"), F.col("Action").alias("event type"))
    export_delimited(other, f"{work}/raw/b", ";")
    run_etl(spark, f"{work}/raw", f"{work}/lake")
    return read_lake(spark, f"{work}/lake").select(*_FILE_COLUMNS)


def etl_quoted_newlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line breaks inside quotes, read with ``multi_line``."""
    work = run_dir(spark, "etl-newlines")
    raw = _events_file(spark, sf_dir).withColumn("Props", F.concat(F.lit('first line, "quoted"\n'), "Props"))
    export_delimited(raw, f"{work}/raw", ",")
    run_etl(spark, f"{work}/raw", f"{work}/lake", multi_line=True)
    return read_lake(spark, f"{work}/lake").select(*_FILE_COLUMNS)


def etl_newlines_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line breaks inside quotes in some files of a folder, without any setting: those are read as a whole, the others by line."""
    work = run_dir(spark, "etl-newlines-mixed")
    raw = _events_file(spark, sf_dir)
    breaks = F.col("Session ID") % 3 == 0
    export_delimited(raw.filter(breaks).withColumn("Props", F.concat(F.lit('first line, "quoted"\n'), "Props")), f"{work}/raw/breaks", ",")
    export_delimited(raw.filter(~breaks), f"{work}/raw/plain", ",")
    result = run_etl(spark, f"{work}/raw", f"{work}/lake")
    if not all("/breaks/" in f for x in result.layouts for f in x.whole):
        raise AssertionError("a file without line breaks was read as a whole")
    return read_lake(spark, f"{work}/lake").select(*_FILE_COLUMNS)


def etl_quoted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that end in a quote sign, hold a quoted word, or are a quote sign only."""
    work = run_dir(spark, "etl-quoted")
    kind, word = F.col("Session ID") % 4, F.col("Action")
    note = (F.when(kind == 0, F.concat(word, F.lit(' 55"'))).when(kind == 1, F.concat(F.lit('"'), word, F.lit('"')))
            .when(kind == 2, F.lit('"')).otherwise(F.concat(F.lit('say "'), word, F.lit('" twice'))))
    export_delimited(_events_file(spark, sf_dir).drop("Props").withColumn("Note", note), f"{work}/raw", ",")
    run_etl(spark, f"{work}/raw", f"{work}/lake")
    return read_lake(spark, f"{work}/lake").select("session_id", "event_type", "price", "note")


def etl_rerun_shrunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rerun of an input that has lost its first day, under both overwrite modes of the session: no row of that day stays."""
    key, parts = "spark.sql.sources.partitionOverwriteMode", []
    before = spark.conf.get(key)
    raw = table(spark, sf_dir, "events").select(F.col("event_id").alias("Session ID"), F.col("ts").alias("Timestamp"))
    first = raw.agg(F.to_date(F.min("Timestamp"))).first()[0]
    try:
        for mode in ("static", "dynamic"):
            work = run_dir(spark, "etl-shrunk")
            spark.conf.set(key, mode)
            for part in (raw, raw.filter(F.to_date("Timestamp") > F.lit(first))):
                part.write.mode("overwrite").option("header", True).csv(f"{work}/raw")
                run_etl(spark, f"{work}/raw", f"{work}/lake")
            parts.append(read_lake(spark, f"{work}/lake").select(F.lit(mode).alias("mode"), "session_id", PARTITION_COLUMN))
    finally:
        spark.conf.set(key, before)
    return parts[0].unionAll(parts[1])


def etl_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a field too many, too few, or cut by a quote are counted and kept in the quarantine; the others are loaded."""
    work = run_dir(spark, "etl-malformed")
    line = F.concat_ws(",", F.col("event_id"), "event_type", "value")
    kind = F.col("event_id") % 10
    broken = F.when(kind == 1, F.concat(line, F.lit(",extra"))).when(kind == 2, F.concat_ws(",", "event_id", "event_type")).when(kind == 3, F.concat_ws(",", F.col("event_id"), F.lit('cut"'), F.col("value"))).otherwise(line)
    # every part file begins with its own header line
    rows = table(spark, sf_dir, "events").select(broken.alias("session_id,action,price"))
    rows.write.option("header", True).option("quote", "").option("escapeQuotes", False).option("sep", "\x01").csv(f"{work}/raw")
    result = run_etl(spark, f"{work}/raw", f"{work}/lake", quarantine=f"{work}/quarantine")
    kept = read_lake(spark, f"{work}/lake").select(F.lit("loaded").alias("place"), F.col("session_id").alias("content"), "price")
    bad = spark.read.parquet(f"{work}/quarantine").select(F.lit("quarantine").alias("place"), F.col("line").alias("content"), F.lit(None).cast("double").alias("price"))
    counted = spark.range(1).select(F.lit("counted").alias("place"), F.lit(str(result.metrics["rows_malformed"])).alias("content"), F.lit(None).cast("double").alias("price"))
    return kept.union(bad).union(counted)


def etl_ids_with_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long numbers as ids, next to missing ones: no two ids become one, and whole numbers with gaps stay whole."""
    work = run_dir(spark, "etl-gaps")
    raw = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 10 != 0, (F.col("event_id") + F.lit(9007199254740992)).cast("string")).alias("Session ID"),
        F.when(F.col("event_id") % 7 != 0, F.col("event_id") + F.lit(9007199254740992)).alias("Order"), F.col("event_id").alias("Row"))
    export_delimited(raw, f"{work}/raw", ",")
    run_etl(spark, f"{work}/raw", f"{work}/lake")
    return read_lake(spark, f"{work}/lake").select("session_id", "event_sequence", "row")


def etl_type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One input with numbers as ids, then one with letters in them, in one lake."""
    work = run_dir(spark, "etl-drift")
    raw = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("Session ID"), F.col("user_id").cast("string").alias("Extra"), F.col("value").alias("Price"))
    for name, part in (("numbers", raw.filter("`Session ID` % 2 = 0")), ("letters", raw.filter("`Session ID` % 2 <> 0").withColumns({"Session ID": F.concat(F.lit("A"), "Session ID"), "Extra": F.concat("Extra", F.lit("x"))}))):
        export_delimited(part, f"{work}/{name}", ",")
        run_etl(spark, f"{work}/{name}", f"{work}/lake")
    return read_lake(spark, f"{work}/lake").select("session_id", "extra", "price")


def etl_event_time_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in an hour that some zones skip, under a session in such a zone: they stay as written."""
    work = run_dir(spark, "etl-zone")
    raw = table(spark, sf_dir, "events").select(F.col("event_id").alias("Session ID"), F.concat(F.lit("03/09/2008 02:"), F.lpad((F.col("event_id") % 60).cast("string"), 2, "0"), F.lit(":00")).alias("Timestamp"))
    export_delimited(raw, f"{work}/raw", ",")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        run_etl(spark, f"{work}/raw", f"{work}/lake")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return read_lake(spark, f"{work}/lake").select("session_id", "event_time", "event_hour", PARTITION_COLUMN)


def etl_bare_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date column alone, in three layouts, some unreadable: all derived columns are null there."""
    work = run_dir(spark, "etl-date")
    day, kind = F.to_date("ts"), F.col("event_id") % 4
    text = (F.when(kind == 0, day.cast("string")).when(kind == 1, F.date_format(day, "MM/dd/yyyy"))
            .when(kind == 2, F.date_format(day, "dd.MM.yyyy")).otherwise("never"))
    export_delimited(table(spark, sf_dir, "events").select(F.col("event_id").alias("Session ID"), text.alias("Date")), f"{work}/raw", ",")
    run_etl(spark, f"{work}/raw", f"{work}/lake")
    return read_lake(spark, f"{work}/lake").select("session_id", "event_time", "event_date", "event_hour", "event_month", "day_of_week")


def etl_schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required and optional columns of the raw clickstream file, and whether each is there, with its type."""
    typed = _typed_export(spark, clickstream_raw(spark, sf_dir), ",")
    return schema_report(typed)


SEPARATOR_NAMES = {",": "comma", ";": "semicolon", "\t": "tab", "|": "pipe"}


def etl_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows exported with each separator, sniffed, scanned and typed."""
    src = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("SessionId"), F.col("event_type").alias("event type"),
        F.col("value").alias("amount"), F.col("props").alias("Props"))
    work = run_dir(spark, "etl-separators")
    parts = []
    for sep, name in SEPARATOR_NAMES.items():
        export_delimited(src, f"{work}/{name}", sep)
        typed, found, _ = read_events_file(spark, f"{work}/{name}")
        parts.append(well_formed(typed).select(F.lit(name).alias("file"),
                                               F.lit(SEPARATOR_NAMES[found[0].sep]).alias("detected"), "*"))
    return reduce(DataFrame.unionByName, parts)


def lake_days_query(spark: SparkSession, sf_dir: str, name: str,
                    first: str | None = None, last: str | None = None) -> DataFrame:
    """A named query over the ETL'd lake, optionally on a range of days
    (a partition filter: only those day folders are listed and read)."""
    _, lake = _clickstream_lake(spark, sf_dir)
    if first:
        lake = days_between(lake, first, last)
    return run_query(spark, lake, name)


# -- single ETL steps over the same exports (finer-grained checks) -----------

def _typed_export(spark: SparkSession, raw: DataFrame, sep: str) -> DataFrame:
    work = run_dir(spark, "etl-steps")
    export_delimited(raw, f"{work}/raw", sep)
    typed, *_ = read_events_file(spark, f"{work}/raw")
    return well_formed(typed)


def etl_step(spark: SparkSession, sf_dir: str, step: str) -> DataFrame:
    """One stage of the clickstream ETL: ``map_columns`` (scan, map, type),
    ``drop_duplicates``, ``trim`` (after dedup), ``event_time`` (after dedup
    and trim), ``derived_columns`` (hour, month, weekday) or ``fill_missing``
    (the whole cleaning, before the write)."""
    typed = _typed_export(spark, clickstream_raw(spark, sf_dir), ",")
    if step == "map_columns":
        return typed
    if step == "drop_duplicates":
        return drop_duplicate_rows(typed)
    if step == "trim":
        return (typed.transform(drop_duplicate_rows).transform(trim_text)
                .select("session_id", "event_type", "product_id", "country"))
    if step == "event_time":
        return (typed.transform(drop_duplicate_rows).transform(trim_text)
                .transform(build_event_datetime)
                .select("session_id", "event_type", "event_time", "event_date"))
    if step == "derived_columns":
        return (typed.transform(drop_duplicate_rows).transform(trim_text)
                .transform(build_event_datetime).transform(add_derived_columns)
                .select("session_id", "event_time", "event_hour", "event_month", "day_of_week"))
    if step == "fill_missing":
        return clean_events(typed).select("session_id", "event_type", "country", "price",
                                          "category_id", "category_name", "event_date_str")
    raise KeyError(step)


def etl_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales export: event date and midnight time built from year/month/day."""
    typed = _typed_export(spark, sales_raw(spark, sf_dir), ";")
    return (typed.transform(drop_duplicate_rows).transform(build_event_datetime)
            .select("session_id", "event_sequence", "year", "month", "day",
                    "event_time", "event_date"))
