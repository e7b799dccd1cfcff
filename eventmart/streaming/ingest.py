"""Incremental ETL: new files in a landing folder -> the day-partitioned lake.

A Structured Streaming file source lists the landing folder and hands every micro-batch the files not seen
before (tracked in the checkpoint).  Each micro-batch is one input of the batch ETL (``operators.etl.run_etl``):
the same headers by file, declared types, malformed rows and lake writer, so batch and stream can share a lake.
Its source id holds the batch number; a batch that is run again after a failure replaces its own
rows, which makes the ingest exactly-once.  There is no state and no watermark: late events are written like all
others.  As in the batch ETL, copies of a row are dropped within one input, here a micro-batch.

``trigger(availableNow=True)`` processes everything pending and stops, so a
scheduled job gets batch-like runs that only touch new files.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventmart.operators.etl import run_etl


#: What the file source tells of a file; only its path is read.
_FILES = "path string, modificationTime timestamp, length long, content binary"


def start_ingest(spark: SparkSession, landing: str, lake: str, checkpoint: str, *, sep: str | None = None,
                 quarantine: str | None = None, multi_line: bool | None = None, available_now: bool = True,
                 name: str | None = None) -> StreamingQuery:
    """Start the incremental ingest.  ``name`` tells the ingests of one lake apart (by default the checkpoint does)."""
    name = name or f"ingest-{hashlib.sha256(checkpoint.encode()).hexdigest()[:12]}"

    def add(batch: DataFrame, number: int) -> None:
        files = [r["path"] for r in batch.collect()]          # names of the new files only
        if files:
            run_etl(spark, files, lake, source=f"{name}-{number:08d}", sep=sep, quarantine=quarantine, multi_line=multi_line)

    arrivals = spark.readStream.format("binaryFile").schema(_FILES).load(landing).select("path")
    writer = arrivals.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
