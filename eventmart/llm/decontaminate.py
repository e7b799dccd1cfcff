"""Benchmark decontamination with one Aho-Corasick automaton.

The items' windows (``window`` consecutive words; a shorter item is one window) are normalised (A-Z in
lower case, words joined by single spaces) and make one automaton, built once, sent to the executors and
run once over each whole normalised text.  Words of a match are hit; hits map back to code point offsets of the
original text.  The benchmark is a bounded side: an automaton takes at most ``MAX_CHARS`` characters of windows,
and a larger benchmark is cut by item into several automata, each run over all texts, whose results are
merged per document.

Defined results: null and empty texts have no words and no hits; an item without words matches nothing; equal
windows of several items count for each; rows that repeat a doc_id are reported one by one; an empty
benchmark leaves every document clean; other columns, whatever their names, are ignored by
``contamination`` and kept as they are by ``drop_contaminated``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import column, stage, table, take

MAX_CHARS = 4_000_000
#: Rows of a batch that are taken together.
ROWS_AT_ONCE = 500
#: Words of the text as it stands, capitals included.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Letters to lower case, every byte that is no part of a word to a space.
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def item_windows(text: str, window: int) -> set[bytes]:
    w = words_of(text.encode())
    if not w:
        return set()
    return {b" ".join(w[i:i + window]) for i in range(max(1, len(w) - window + 1))}


class Automaton:
    """All windows of some items in one machine; it pickles, so it is built on the driver and broadcast."""

    def __init__(self, items: dict[bytes, list[str]]):
        import ahocorasick
        self.machine = ahocorasick.Automaton()
        for text, ids in items.items():
            # bytes as Latin-1 characters, so that positions are byte positions; spaces at both ends make whole words
            self.machine.add_word(f" {text.decode('latin-1')} ", (text.count(b" ") + 1, tuple(ids)))
        if items:
            self.machine.make_automaton()

    def find(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Numbers of the hit words, and the items found."""
        if not len(self.machine) or not words:
            return np.zeros(0, np.int64), set()
        text = b" " + b" ".join(words) + b" "
        ends, sizes, items = [], [], set()
        for end, (n, ids) in self.machine.iter(text.decode("latin-1")):
            ends.append(end)
            sizes.append(n)
            items.update(ids)
        if not ends:
            return np.zeros(0, np.int64), items
        blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
        after = np.searchsorted(blanks, np.array(ends))          # number of the word after the match
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, after - np.array(sizes), 1)
        np.add.at(edge, after, -1)
        return np.flatnonzero(np.cumsum(edge)[:-1] > 0), items


def automata(benchmark: DataFrame, id_column: str, text_column: str, window: int) -> list[Automaton]:
    """Windows of all items, cut by ``MAX_CHARS``.  Items are read one after the other."""
    parts: list[dict[bytes, list[str]]] = [{}]
    size = 0
    items = take(benchmark, item=id_column, text=text_column).select(F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    for row in items.toLocalIterator():
        windows = item_windows(row["text"], window)
        grown = sum(map(len, windows))
        if parts[-1] and size + grown > MAX_CHARS:
            parts.append({})
            size = 0
        size += grown
        for w in windows:
            ids = parts[-1].setdefault(w, [])
            if row["item"] not in ids:
                ids.append(row["item"])
    return [Automaton(x) for x in parts]


def original_spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code point ranges of runs of hit words in the original text."""
    if not len(hit):
        return []
    edge = np.flatnonzero(np.r_[True, np.diff(hit) > 1])
    first, last = hit[edge], hit[np.r_[edge[1:], len(hit)] - 1]
    ends, out, starts = dict(zip(last.tolist(), range(len(last)), strict=True)), [], set(first.tolist())
    for i, m in enumerate(_WORD.finditer(text)):
        if i in starts:
            out.append([m.start(), 0])
        if i in ends:
            out[-1][1] = m.end()
    return [(a, b) for a, b in out]


_FOUND = "n_words long, hit array<long>, items array<string>"


def _search(docs: DataFrame, machines: list[Automaton]) -> DataFrame:
    """``docs`` (whose text is ``_text``) with n_words, hit (word numbers) and items; one pass an automaton."""
    spark = docs.sparkSession
    own = docs.schema
    schema = T.StructType([*own.fields, *T._parse_datatype_string(_FOUND).fields])
    for k, machine in enumerate(machines):
        shared = spark.sparkContext.broadcast(machine)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, again=k > 0) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for i in range(0, whole.num_rows, ROWS_AT_ONCE):
                    batch = whole.slice(i, ROWS_AT_ONCE)
                    n_words, hits, items = [], [], []
                    old = zip(batch.column("hit").to_pylist(), batch.column("items").to_pylist(), strict=True) if again else iter(lambda: ((), ()), 0)
                    for text, (old_hit, old_items) in zip(column(batch, "_text").cast(pa.binary()).to_pylist(), old, strict=False):
                        words = words_of(text)
                        hit, found = shared.value.find(words)
                        n_words.append(len(words))
                        hits.append(np.union1d(hit, np.array(old_hit, np.int64)) if len(old_hit) else hit)
                        items.append(sorted(found | set(old_items)))
                    columns = [batch.column(f.name) for f in own.fields]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], schema.names)

        docs = docs.mapInArrow(run, schema)
        if k + 1 < len(machines):
            docs = stage(docs, "decontaminate")
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items and spans (code point
    ranges of hit words in the original text)."""
    own = take(docs, doc_id=id_column, _text=text_column)
    found = _search(own, automata(benchmark, item_column, item_text, window))
    id_field = own.schema["doc_id"]
    schema = T.StructType([id_field, *T._parse_datatype_string("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans array<struct<start:long,end:long>>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column("items").to_pylist()
            hits = [np.array(x, np.int64) for x in batch.column("hit").to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in original_spans(t.as_py(), h)] if len(h) else [] for t, h in zip(column(batch, "_text"), hits, strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("n_words"), pa.array([len(h) for h in hits], pa.int64()), pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]), pa.array([len(h) > 0 for h in hits]),
                batch.column("items"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ], schema.names)

    return found.mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """The documents, all columns, that hold no window of the benchmark."""
    names = docs.columns
    kept = docs.toDF(*[f"_{i}" for i in range(len(names))])
    text, schema = f"_{names.index(text_column)}", kept.schema
    machines = automata(benchmark, item_column, item_text, window)
    for k, machine in enumerate(machines):
        shared = docs.sparkSession.sparkContext.broadcast(machine)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, ROWS_AT_ONCE):
                    some = batch.slice(i, ROWS_AT_ONCE)
                    clean = [not len(shared.value.find(words_of(t))[0]) for t in column(some, text).cast(pa.binary()).to_pylist()]
                    yield some.filter(pa.array(clean))

        kept = kept.mapInArrow(run, schema)
        if k + 1 < len(machines):
            kept = stage(kept, "decontaminate")
    return kept.toDF(*names)


def op5_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of ten words of any benchmark item."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP5_SQL = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, len(w[u.i + 1:u.i + 10]) AS size, array_to_string(w[u.i + 1:u.i + 10], ' ') AS text
  FROM items, LATERAL (SELECT unnest(range(greatest(1, len(w) - 9))) AS i) u WHERE len(w) > 0),
docs AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, s.size AS size, u.i AS i, array_to_string(w[u.i + 1:u.i + s.size], ' ') AS text
  FROM docs, (SELECT DISTINCT size FROM windows) s, LATERAL (SELECT unnest(range(greatest(0, len(w) - s.size + 1))) AS i) u),
found AS (SELECT p.doc_id, p.i, p.size, x.item FROM places p JOIN windows x ON p.size = x.size AND p.text = x.text),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, LATERAL (SELECT unnest(range(size)) AS k) u GROUP BY doc_id),
per_item AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) f GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(p.n_items, 0) AS n_items,
       sha256(coalesce(p.items, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN words h ON d.doc_id = h.doc_id LEFT JOIN per_item p ON d.doc_id = p.doc_id"""
