"""Session construction and the shared work folder.

Library code never builds its own session; it takes the caller's.  ``build_session``
is for tests, ``bench.py`` and command-line use.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "eventmart",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and the command line.

    Under ``spark-submit`` (no ``master`` given), the submit's master and the
    cluster's sizing (shuffle partitions, memory) are kept; only AQE and the
    session zone are set.  Otherwise a ``local[BENCH_CPUS|8]`` session is
    built with test-sized settings."""
    submitted = master is None and "PYSPARK_GATEWAY_PORT" in os.environ
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if not submitted:
        builder = (
            builder.master(master or f"local[{os.environ.get('BENCH_CPUS', '8')}]")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.driver.memory", "16g")
        )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-wide folder for written intermediate tables.

    This is ``spark.checkpoint.dir`` as the cluster sets it.  Only when the
    session has none do we create one and register it, and only in local mode
    (a test session): on a cluster a machine-local folder would not be shared,
    so a missing setting is an error there.
    """
    conf = spark.sparkContext.getConf()
    d = conf.get("spark.checkpoint.dir", None)
    if not d:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current.rstrip("/")
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder on shared storage")
        d = tempfile.mkdtemp(prefix="eventmart-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


_OWN_FOLDERS: dict[str, str] = {}


def _drop(path, conf) -> None:
    """Delete a work folder at the program's end, unless the JVM is gone already."""
    with contextlib.suppress(Py4JError, OSError):
        path.getFileSystem(conf).delete(path, True)


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared dir; every call gets its own, so lazily
    evaluated DataFrames that read it are never overwritten by a later call.  All of an application's folders
    lie in one, which is deleted when the program ends."""
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        _OWN_FOLDERS[app] = f"{shared_dir(spark)}/eventmart/{app}-{uuid.uuid4().hex[:12]}"
        atexit.register(_drop, spark._jvm.org.apache.hadoop.fs.Path(_OWN_FOLDERS[app]), spark._jsc.hadoopConfiguration())
    return f"{_OWN_FOLDERS[app]}/{label}-{uuid.uuid4().hex[:12]}"
