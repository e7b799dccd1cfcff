"""What the text operators share: reading inputs, columns by name, written stages, bounded broadcasts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.session import run_dir


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package where they would not find it: neither on ``PYTHONPATH`` nor in the folder
    that Python starts in.  (A cluster job that passes it with ``--py-files`` has it on the path.)"""
    package = Path(__file__).resolve().parents[1]
    root = str(package.parent)
    sc = spark.sparkContext
    places = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if root in places or f"{package.name}.zip" in sc._python_includes:
        return
    folder = tempfile.mkdtemp(prefix=f"{package.name}-code-")
    sc.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", root, package.name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def take(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns only, renamed: ``take(df, doc_id="id", body="text")`` reads ``id`` and ``text``.

    Names are matched exactly first, then without case; of several equal names the first counts.  Other
    columns, whatever their names, are left behind."""
    have = df.columns
    plain = df.toDF(*[f"_{i}" for i in range(len(have))])
    out = []
    for new, old in columns.items():
        hits = [i for i, c in enumerate(have) if c == old] or [i for i, c in enumerate(have) if c.lower() == old.lower()]
        if not hits:
            raise ValueError(f"column {old!r} is missing; there are {have}")
        out.append(F.col(f"_{hits[0]}").alias(new))
    return plain.select(*out)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared work folder and read back: what follows never recomputes ``df``, also when
    executors are lost."""
    give_back()
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hashed_sample(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """At most ``n`` rows, those whose columns have the smallest hashes: the same rows in every run.

    Rows with large hashes are left out where they are read, so that no task has to rank ``n`` rows of each other."""
    h, share = F.xxhash64(*columns, F.lit(17)), 4 * n / max(df.count(), 1)
    few = df.filter(F.shiftrightunsigned(h, 11).cast("double") < share * 2.0 ** 53) if share < 1 else df
    return few.orderBy(h, *columns).limit(n)


def give_back() -> None:
    """Return what Python, numpy and Arrow no longer use to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column as one string array without nulls (null: empty).  What Arrow holds of earlier batches is given back."""
    pa.default_memory_pool().release_unused()
    got = batch.column(name)
    if pa.types.is_null(got.type):
        got = pa.array([""] * len(got), pa.string())
    return got.fill_null("") if got.null_count else got


def text_bytes(df: DataFrame, name: str = "text") -> int:
    """UTF-8 bytes of a string column."""
    return df.select(F.coalesce(F.sum(F.octet_length(F.col(name))), F.lit(0)).alias("n")).first()["n"]


# -- Bloom filters in Arrow tasks -------------------------------------------------------------------------
#: Bits are merged in blocks of so many, one row each.
BLOCK_BITS = 1 << 18


def filter_bits(expected: int, per_key: int = 10, least: int = 1 << 20, most: int = 1 << 29) -> int:
    """Size of a filter: a power of two, ``per_key`` bits a key, never over ``most`` (64 MB), which bounds
    what is broadcast.  Beyond that the filter only lets more keys through; what follows it is exact."""
    return int(min(most, max(least, 1 << math.ceil(math.log2(max(expected * per_key, 1))))))


def probes(h: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions of each 64-bit hash, one row each."""
    mask = np.uint64(bits - 1)
    return np.stack([h & mask, (h >> np.uint64(32)) * np.uint64(0x9E3779B1) + (h & np.uint64(0xFFFF)) & mask])


def in_filter(h: np.ndarray, bits: int, bitmap: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set in a packed bitmap (little-endian bits)."""
    a, b = probes(h, bits)
    one = lambda p: (bitmap[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1
    return (one(a) & one(b)).astype(bool)


def block_rows(positions: np.ndarray, bits: int) -> list[tuple[int, bytes]]:
    """Ascending bit positions as (block, offsets in the block) rows."""
    if not len(positions):
        return []
    block = (positions // BLOCK_BITS).astype(np.int64)
    edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    ends = np.r_[edge[1:], len(block)]
    return [(int(block[a]), (positions[a:b] % BLOCK_BITS).astype("<u4").tobytes()) for a, b in zip(edge, ends, strict=True)]


def _or_blocks(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(BLOCK_BITS, bool)
    for batch in batches:
        for x in batch.column("offsets"):
            bits[np.frombuffer(x.as_py(), "<u4")] = True
    yield pa.RecordBatch.from_pydict({"block": pa.array([key[0].as_py()], pa.int64()), "bitmap": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def key_filter(keys: DataFrame) -> tuple[int, np.ndarray]:
    """A Bloom filter of the 64-bit keys in the only column of ``keys``: size in bits and bitmap, 64 MB at most."""
    from eventmart.llm.textvec import mix
    bits = filter_bits(keys.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = mix(batch.column(0).to_numpy().astype(np.int64).view(np.uint64))
            rows = block_rows(np.unique(probes(h, bits)), bits)
            if rows:
                yield pa.RecordBatch.from_pydict({"block": pa.array([r[0] for r in rows], pa.int64()), "offsets": pa.array([r[1] for r in rows], pa.binary())})

    merged = keys.mapInArrow(run, "block long, offsets binary").groupBy("block").applyInArrow(_or_blocks, "block long, bitmap binary")
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():
        at = row["block"] * BLOCK_BITS // 8
        bitmap[at: at + BLOCK_BITS // 8] = np.frombuffer(row["bitmap"], np.uint8)
    return bits, bitmap


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over edges (a, b), for every node with an edge.

    Large-star and small-star rounds on the edge table until it no longer changes; every round is written,
    so that plans stay short and lost executors cost one round."""
    current, mark = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"), None
    while True:
        both = current.union(current.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(small, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").union(small.select("u", "m"))
        current = stage(linked.distinct(), "edges")
        now = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(current.select("b", "b").distinct())
        mark = now
