"""The event lake (Parquet by input and day) and the table store.

Layout: ``<root>/source_id=<input>/_snapshot=<version>/event_date_str=YYYY-MM-DD/part-*.parquet``.  An input (its ``source_id``) owns
its folder: another input only adds files.  A rerun of the same input writes a version of its own, which replaces the earlier one
when it is whole (``snapshots``), whatever the session's overwrite mode; until then, and if it fails, readers see the earlier rows.
Reading with a filter on ``event_date_str`` prunes whole directories (``PartitionFilters``); selecting a few
columns prunes the Parquet columns (``ReadSchema``).  Lakes are read by ``read_lake``, which knows the versions.
"""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventmart.sources.snapshots import VERSION_COLUMN, Snapshots

SOURCE_COLUMN = "source_id"
PARTITION_COLUMN = "event_date_str"
MAX_RECORDS_PER_FILE = 5_000_000
#: Partitions that days are dealt out to before small ones are merged: with few days in each, a day is cut only if it is large itself.
#: Above 200 (``spark.shuffle.sort.bypassMergeThreshold``) a task would sort its rows in memory to deal them out.
DAY_PARTITIONS = 200
#: Days that a task writes side by side as they come; only the rows of further days are sorted.
DAYS_AT_ONCE = 64
#: Spark deletes the shuffle files of a query when it ends, not when the driver's JVM happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables that a store writes at once.
WRITES_AT_ONCE = 8


def checked_source(source: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", source):
        raise ValueError(f"a source id has letters, digits, '.', '_' and '-' only: {source!r}")
    return source


def source_folder(path: str, source: str) -> str:
    return f"{path.rstrip('/')}/{SOURCE_COLUMN}={checked_source(source)}"


def lake_snapshots(spark: SparkSession, path: str) -> Snapshots:
    return Snapshots(spark, path, f"{SOURCE_COLUMN}={{name}}")


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the time of a write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def deal_by_day(df: DataFrame, day: str = PARTITION_COLUMN) -> DataFrame:
    """The rows of a day together, as ``write_days`` needs them.

    ``rebalance`` lets AQE cut a hot day into several tasks (and merge tiny days), so neither one huge task nor tasks x days small
    files.  What can be derived from other columns is best derived afterwards, so that it is not shuffled."""
    return df.hint("rebalance", DAY_PARTITIONS, day)


def write_days(df: DataFrame, folder: str, column: str = PARTITION_COLUMN, **options) -> None:
    """Add rows to a folder partitioned by ``column``, as they are dealt out.  The rows of a task are not sorted by it first, which
    would hold them all in memory; the write's shuffle files are deleted when it ends."""
    with _setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(DAYS_AT_ONCE)), _setting(df.sparkSession, SHUFFLE_CLEANUP, "true"):
        (df.write.mode("append")
           .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
           .options(**options)
           .partitionBy(column)
           .parquet(folder))


def write_version(df: DataFrame, path: str, source: str) -> str:
    """Write the events of one input, partitioned by day, as a version that nobody sees yet."""
    log = lake_snapshots(df.sparkSession, path)
    version = log.begin()
    write_days(deal_by_day(df), log.folder(checked_source(source), version))
    return version


def write_lake(df: DataFrame, path: str, source: str) -> None:
    """Write the events of one input in place of its earlier events."""
    lake_snapshots(df.sparkSession, path).commit(source, write_version(df, path, source))


def read_lake(spark: SparkSession, path: str, versions: dict[str, str] | None = None) -> DataFrame:
    """The lake as one DataFrame, columns of all inputs; the day column stays text (``yyyy-MM-dd``),
    whatever the directory names look like (a null day reads back as null).

    The versions and files are those of now: after a later write to the same lake, read
    it again rather than reusing this frame.  ``versions`` (input -> version) reads just these instead."""
    log = lake_snapshots(spark, path)
    versions = log.versions() if versions is None else versions
    folders = [log.folder(name, v) for name, v in sorted(versions.items())]
    if not folders:
        raise ValueError(f"no events in {path}")
    reader = spark.read.option("basePath", path.rstrip("/"))
    found = reader.option("mergeSchema", True).parquet(*folders).schema
    text = (SOURCE_COLUMN, PARTITION_COLUMN, VERSION_COLUMN)
    schema = StructType([StructField(f.name, StringType()) if f.name in text else f for f in found])
    return spark.read.option("basePath", path.rstrip("/")).schema(schema).parquet(*folders).drop(VERSION_COLUMN)


def days_between(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of days ``first..last`` (inclusive, ``yyyy-MM-dd``): a partition filter."""
    return df.filter(F.col(PARTITION_COLUMN).between(first, last))


class TableStore:
    """Named result tables (marts, job outputs) stored as Parquet under ``root``.

    ``root`` is a folder on shared storage, and every answer comes from it, so a store reopened later by
    another job sees the same tables.  A table that is written again stays readable as it was until the new one is
    whole, and a write that fails leaves it so.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = Snapshots(spark, self.root)

    def path(self, name: str) -> str:
        """Folder of the table as it is now."""
        folder = self._log.current(name)
        if folder is None:
            raise KeyError(f"no table {name!r} in {self.root}")
        return folder

    def write(self, name: str, df: DataFrame) -> DataFrame:
        version = self._log.begin()
        df.write.mode("errorifexists").parquet(self._log.folder(name, version))
        self._log.commit(name, version)
        return self._at(self._log.folder(name, version), df.schema)

    def write_all(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write several tables, some at once, so that small ones do not wait for each other's last tasks.  They are
        named one after the other when all are whole; if one fails, all stay as they were."""
        versions = {name: self._log.begin() for name in tables}
        with ThreadPoolExecutor(WRITES_AT_ONCE) as pool:
            list(pool.map(lambda t: tables[t].write.mode("errorifexists").parquet(self._log.folder(t, versions[t])), tables))
        for name, version in versions.items():
            self._log.commit(name, version)
        return {name: self._at(self._log.folder(name, versions[name]), df.schema) for name, df in tables.items()}

    def read(self, name: str) -> DataFrame:
        return self._at(self.path(name))

    def _at(self, folder: str, schema: StructType | None = None) -> DataFrame:
        # the folder itself, without its name as a column
        reader = self.spark.read.option("basePath", folder)
        return (reader.schema(schema) if schema else reader).parquet(folder)

    def exists(self, name: str) -> bool:
        return self._log.current(name) is not None

    def names(self) -> list[str]:
        """The tables in storage."""
        return sorted(self._log.versions())

    def tables(self) -> dict[str, DataFrame]:
        return {n: self.read(n) for n in self.names()}
