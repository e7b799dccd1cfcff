"""Result sinks: CSV export, preview, and per-table row counts.

Nothing here funnels data through one task: CSV is written by every task of
the result (AQE already shrinks small post-aggregate results to few files).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """Result -> CSV folder with a header line (replaces what was there)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_csv_if_any(df: DataFrame, path: str) -> bool:
    """``write_csv`` for a result that has rows; says whether it has.  The result runs once: it is written beside the
    folder, its rows are counted on the way, and it takes the folder's place if there are any."""
    spark, rows = df.sparkSession, Observation()
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    draft, final = jvm_path(f"{path.rstrip('/')}.{uuid.uuid4().hex[:8]}.tmp"), jvm_path(path.rstrip("/"))
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        write_csv(df.observe(rows, F.count(F.lit(1)).alias("n")), draft.toString())
        if not rows.get["n"]:
            return False
        fs.delete(final, True)
        return bool(fs.rename(draft, final))
    finally:
        fs.delete(draft, True)


def read_csv(spark, path: str, schema) -> DataFrame:
    """A result written by ``write_csv``, read back with its own schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows of a result, in its own order."""
    return df.limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for every table: one plan, one job."""
    if not tables:
        raise ValueError("no tables")
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, parts)
