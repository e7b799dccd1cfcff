"""Token ids in plane-shuffled files.

Segments of consecutive documents' ids are cut into blocks of a fixed number of ids.  A block is transposed
into byte planes (first bytes of all ids, then second bytes, …) or bit planes and every plane is compressed with
zstandard by itself.  A segment is one binary value:

    magic "IDPL", plane kind (1 byte: 8 = bytes, 1 = bits), planes a block (1 byte),
    ids a block (4 bytes), ids (8 bytes), blocks (4 bytes)              header, little-endian
    one 4-byte size for each block and plane                            chunk index
    the compressed planes, in that order

so that ``read_block`` finds any block from the index alone.  Segments are the rows of a Parquet folder, written by
Spark to any store it can write: (shard, segment, start in the shard, doc_ids, n_tokens of each, data).  Shards
are ranges of doc_id in ascending order; the position of an id is its shard's first position (a sum of
totals, one row a shard) plus that of its segment.  A document lies in one segment, so reading needs no
order between rows; a segment is closed at ``SEGMENT_IDS`` ids or with one longer document.

Defined results: a null or empty text is the end id alone; a null doc_id sorts first; rows that repeat a doc_id
are all written, next to one another; an empty table gives an empty folder with a schema; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import table, take
from eventmart.llm.tokens import encoder, texts_of
from eventmart.session import run_dir

SEGMENT_IDS = 1 << 20
BLOCK_IDS = 1 << 16
LEVEL = 1
_HEAD = struct.Struct("<4sBBIQI")
_PLANES = {"byte": (8, 4), "bit": (1, 32)}


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of a block, lowest first."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [raw[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(data: list[bytes], n: int) -> np.ndarray:
    if len(data) == 4:
        raw = np.stack([np.frombuffer(d, np.uint8) for d in data], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(d, np.uint8), count=n, bitorder="little") for d in data], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


def write_segment(ids: np.ndarray, planes: str = "byte", block: int = BLOCK_IDS, level: int = LEVEL) -> bytes:
    import zstandard
    press = zstandard.ZstdCompressor(level=level)
    kind, k = _PLANES[planes]
    chunks = [press.compress(p) for at in range(0, len(ids), block) for p in to_planes(ids[at:at + block], planes)]
    blocks = -(-len(ids) // block)
    return b"".join([_HEAD.pack(b"IDPL", kind, k, block, len(ids), blocks), struct.pack(f"<{len(chunks)}I", *map(len, chunks)), *chunks])


def read_block(data: bytes, number: int) -> np.ndarray:
    """The ids of one block, found by the chunk index."""
    import zstandard
    magic, kind, k, block, total, blocks = _HEAD.unpack_from(data)
    if magic != b"IDPL" or not 0 <= number < blocks:
        raise ValueError("not a block of a plane-shuffled segment")
    sizes = np.frombuffer(data, "<u4", blocks * k, _HEAD.size)
    at = np.r_[0, np.cumsum(sizes, dtype=np.int64)] + _HEAD.size + 4 * blocks * k
    n = min(block, total - number * block)
    size = n if kind == 8 else -(-n // 8)
    press = zstandard.ZstdDecompressor()
    return from_planes([press.decompress(data[at[c]:at[c + 1]], max_output_size=size) for c in range(number * k, (number + 1) * k)], n)


def read_segment(data: bytes) -> np.ndarray:
    blocks = _HEAD.unpack_from(data)[5]
    return np.concatenate([read_block(data, b) for b in range(blocks)] or [np.zeros(0, "<u4")])


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, kind: str = "bytes", end_id: int = 0, planes: str = "byte", id_column: str = "doc_id", text_column: str = "text", literal: bool = False) -> None:
    """Encode all documents and write their ids, in ascending order of doc_id."""
    own = take(docs, doc_id=id_column, text=text_column)
    end = int(end_id).to_bytes(4, "little")
    id_type = own.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("segment", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("n_tokens", T.ArrayType(T.LongType())), T.StructField("data", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, segment, start = encoder(tokenizer_path, kind, literal), TaskContext.get().partitionId(), 0, 0
        ids, parts, counts, held, list_type = [], [], [], 0, None

        def row() -> pa.RecordBatch:
            data = write_segment(np.frombuffer(b"".join(parts), "<u4"), planes)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([start], pa.int64()), pa.array([ids], pa.list_(list_type)), pa.array([counts], pa.list_(pa.int64())), pa.array([data], pa.binary())], schema.names)

        try:
            for batch in batches:
                list_type = batch.schema.field("doc_id").type
                for doc, got in zip(batch.column("doc_id").to_pylist(), enc.encode(texts_of(batch.column("text"))), strict=True):
                    ids.append(doc)
                    parts.append(got + end)
                    counts.append(len(parts[-1]) // 4)
                    held += counts[-1]
                    if held >= SEGMENT_IDS:
                        yield row()
                        segment, start = segment + 1, start + held
                        ids, parts, counts, held = [], [], [], 0
            if ids:
                yield row()
        finally:
            enc.forget()

    ordered = own.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    # the planes are compressed already
    ordered.mapInArrow(run, schema).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32[, ids]."""
    files = spark.read.parquet(path)
    totals = files.groupBy("shard").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    # one row a shard, that is a write task: small enough for one task and a broadcast
    first = totals.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    rows = files.join(F.broadcast(first), "shard").select("doc_ids", "n_tokens", "data", (F.col("first") + F.col("start")).alias("start"))
    id_type = files.schema["doc_ids"].dataType.elementType
    fields = [T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    schema = T.StructType([*fields, T.StructField("ids", T.BinaryType())] if with_ids else fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs = batch.column("doc_ids")[i].values
                counts = batch.column("n_tokens")[i].values.to_numpy()
                ids = memoryview(read_segment(batch.column("data")[i].as_py()).tobytes())
                at = np.r_[0, np.cumsum(counts)]
                parts = [ids[4 * a: 4 * b] for a, b in zip(at, at[1:], strict=False)]
                columns = [docs, pa.array(batch.column("start")[i].as_py() + at[:-1]), pa.array(counts), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(map(bytes, parts), pa.binary())] if with_ids else [])], schema.names)

    return rows.mapInArrow(run, schema)


def op6_token_planes(spark, sf_dir: str) -> DataFrame:
    """All documents' ids written in byte planes and read back."""
    import public_tokenizers
    path = run_dir(spark, "planes")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_ids(spark, path)
