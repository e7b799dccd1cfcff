"""Line dedup with two Bloom filters.

1. Every task hashes the keys of its lines (one hash a document and key) into two bitmaps: bits seen once
   and bits seen again.  Bitmaps are merged block by block; a bit two tasks have seen once counts as seen
   again.  The merged "again" bitmap has a bounded size (``filter_bits``) and is broadcast.
2. Only keys found in that bitmap, the suspected repeats, are shuffled, as whole keys with their
   document: their documents are counted exactly and the keeping document is chosen.  A key that many
   documents hold is spread by document before it is counted.
3. Documents that lose lines get the list of their keys to drop by a join on doc_id.

Defined results: a null text counts as one empty line; a null doc_id is a document of its own below all
others; rows that repeat a doc_id count as one document and lose the same keys; keys shorter than
``min_chars`` code points are never dropped; an empty table gives an empty table; other columns, whatever
their names, stay as they are in ``drop_lines`` and are ignored by ``line_report``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import BLOCK_BITS, block_rows, column, filter_bits, in_filter, probes, table, take, text_bytes
from eventmart.llm.textvec import LOWER, SPACE, mix, slices

_SPACES = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """A line without white space at both ends, A-Z in lower case."""
    return line.strip(_SPACES).lower()


def _long_keys(texts: pa.Array, min_chars: int) -> Iterator[tuple[int, np.ndarray, list[tuple[int, int]], bytes]]:
    """For each slice: text number and hash of the distinct long keys of each text, their byte ranges in
    the lower-cased bytes, and those bytes."""
    for s in slices(texts, lower=True):
        start, end, before = s.lines()
        word_start, word_end = s.spans(~SPACE)
        first = np.searchsorted(word_start, start)
        last = np.searchsorted(word_start, end) - 1
        full = np.flatnonzero(last >= first)
        a, b = word_start[first[full]], word_end[last[full]]
        chars = np.r_[0, np.cumsum((s.buf & 0xC0) != 0x80)]
        long = (chars[b] - chars[a]) >= min_chars
        a, b, line = a[long], b[long], full[long]
        doc = np.searchsorted(before, line, "right") - 1
        h, other = mix(s.hashes(a, b)), s.hashes(a, b, seed=1)
        order = np.lexsort((other, h, doc))
        h, other, doc, a, b = h[order], other[order], doc[order], a[order], b[order]
        # keys of one text are the same if both hashes and their lengths are
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (other[1:] != other[:-1]) | ((b - a)[1:] != (b - a)[:-1]) | (doc[1:] != doc[:-1])
        yield s.first + doc[new], h[new], np.c_[a[new], b[new]], s.buf


def _seen_bits(docs: DataFrame, min_chars: int, bits: int) -> DataFrame:
    """(block, once, again): positions of set bits of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for _, h, _, _ in _long_keys(column(batch, "text"), min_chars):
                parts.append(h)
                if sum(map(len, parts)) > 1_000_000:
                    yield from bits_of(np.concatenate(parts))
                    parts = []
        yield from bits_of(np.concatenate(parts) if parts else np.zeros(0, np.uint64))

    def bits_of(h: np.ndarray) -> Iterator[pa.RecordBatch]:
        h, n = np.unique(h, return_counts=True)
        once = dict(block_rows(np.unique(probes(h, bits)), bits))
        again = dict(block_rows(np.unique(probes(h[n > 1], bits)), bits))
        if once:
            yield pa.RecordBatch.from_pydict({"block": pa.array(list(once), pa.int64()), "once": pa.array(list(once.values()), pa.binary()), "again": pa.array([again.get(k, b"") for k in once], pa.binary())})

    return docs.select("text").mapInArrow(run, "block long, once binary, again binary")


def _merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    once, again = np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool)
    for batch in batches:
        for a, b in zip(batch.column("once"), batch.column("again"), strict=True):
            new = np.frombuffer(a.as_py(), "<u4")
            again[new[once[new]]] = True
            once[new] = True
            again[np.frombuffer(b.as_py(), "<u4")] = True
    yield pa.RecordBatch.from_pydict({"block": pa.array([key[0].as_py()], pa.int64()), "bitmap": pa.array([np.packbits(again, bitorder="little").tobytes()], pa.binary())})


def seen_again(docs: DataFrame, min_chars: int) -> tuple[int, np.ndarray]:
    """Size and bitmap of the keys that two documents may share.  At most 64 MB, by ``filter_bits``."""
    bits = filter_bits(text_bytes(docs) // max(min_chars, 1))
    merged = _seen_bits(docs, min_chars, bits).groupBy("block").applyInArrow(_merge, "block long, bitmap binary")
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():
        at = row["block"] * BLOCK_BITS // 8
        bitmap[at: at + BLOCK_BITS // 8] = np.frombuffer(row["bitmap"], np.uint8)
    return bits, bitmap


def repeated_keys(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(doc_id, keys): what each document has to drop, keys as bytes."""
    bits, bitmap = seen_again(docs, min_chars)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, keys = [], []
            for doc, h, span, buf in _long_keys(column(batch, "text"), min_chars):
                hit = np.flatnonzero(in_filter(h, bits, shared.value))
                which.append(doc[hit])
                keys += [buf[a:b].tobytes() for a, b in span[hit]]
            if keys:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(np.concatenate(which))), pa.array(keys, pa.binary())], ["doc_id", "key"])

    id_type = docs.schema["doc_id"].dataType
    suspects = docs.mapInArrow(run, T.StructType([T.StructField("doc_id", id_type), T.StructField("key", T.BinaryType())])).distinct()
    # distinct() spreads one key's documents; the counts below start from its output, one partial row a task
    counted = suspects.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")).filter(F.col("n") >= min_docs).drop("n")
    drops = suspects.join(counted, "key").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return drops.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))


def _kept_lines(text: bytes, drop: set) -> tuple[list[bytes], int]:
    lines = text.split(b"\n")
    kept = [x for x in lines if line_key(x) not in drop] if drop else lines
    return kept, len(lines)


def _with_drops(docs: DataFrame, id_name: str, text_name: str, min_chars: int, min_docs: int) -> DataFrame:
    """Documents with the column ``_drop_keys``, null where nothing goes."""
    own = docs.select(F.col(id_name).alias("doc_id"), F.col(text_name).alias("text"))
    drops = repeated_keys(own, min_chars, min_docs).toDF("_drop_id", "_drop_keys")
    return docs.join(drops, docs[id_name].eqNullSafe(drops["_drop_id"]), "left").drop("_drop_id")


#: Rows of a batch whose texts are taken apart together.
_ROWS = 500


def line_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, text without the dropped lines, n_lines (before), n_dropped and kept_sha256."""
    own = take(docs, _id=id_column, _text=text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(i, _ROWS)
                texts, n, gone, sha = [], [], [], []
                for text, drop in zip(column(batch, "_text").cast(pa.binary()).to_pylist(), batch.column("_drop_keys").to_pylist(), strict=True):
                    kept, before = _kept_lines(text, set(drop or ()))
                    joined_text = b"\n".join(kept)
                    texts.append(joined_text)
                    n.append(before)
                    gone.append(before - len(kept))
                    sha.append(hashlib.sha256(joined_text).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)], ["doc_id", "text", "n_lines", "n_dropped", "kept_sha256"])

    schema = T.StructType([T.StructField("doc_id", own.schema["_id"].dataType), T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    return _with_drops(own, "_id", "_text", min_chars, min_docs).mapInArrow(run, schema)


def drop_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents, all columns, with repeated lines dropped from the text.  A null text stays null, and a
    document that loses every line stays with an empty text."""
    names = docs.columns
    plain = docs.toDF(*[f"_{i}" for i in range(len(names))])
    at, schema = names.index(text_column), plain.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(i, _ROWS)
                own = [batch.column(f.name) for f in schema.fields]
                texts = [x if not drop or x is None else b"\n".join(_kept_lines(x, set(drop))[0]) for x, drop in zip(own[at].cast(pa.binary()).to_pylist(), batch.column("_drop_keys").to_pylist(), strict=True)]
                own[at] = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(own, [f.name for f in schema.fields])

    return _with_drops(plain, f"_{names.index(id_column)}", f"_{at}", min_chars, min_docs).mapInArrow(run, schema).toDF(*names)


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its number of lines, of dropped lines, and the digest of what stays."""
    return line_report(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.line AS line, u.pos AS pos,
         translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d,
       LATERAL (SELECT unnest(parts) AS line, unnest(range(len(parts))) AS pos) u),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.line, l.pos, r.key IS NOT NULL AND l.doc_id <> r.keeper AS gone
  FROM lines l LEFT JOIN repeated r ON l.key = r.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
