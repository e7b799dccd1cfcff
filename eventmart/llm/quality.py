"""Quality rules: counted rules and a calibrated hashed n-gram classifier.

The classifier is a logistic regression over hashed word and character n-grams
(``hashed_lr``), trained on the driver on at most ``max_rows`` labelled documents, chosen by a hash of their
id, with one fold held back to calibrate the score as a probability.  All documents are then counted and
scored, whole, in Arrow batches, against fixed thresholds.

Defined results: a null or empty text has no words and fails the rules; labels that are null, or of ids
without a document, are not used; of an id labelled more than once the largest label counts; without
labels of both classes the score is one fixed number (``prior``) and only the rules decide; an empty table
gives an empty table; rows that repeat a doc_id are judged one by one; other columns are kept as they are
by ``keep_good`` and ignored by ``quality_report``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import column, give_back, hashed_sample, table, take
from eventmart.llm.hashed_lr import Collected, Features, Model, Rows, fit, platt
from eventmart.llm.textvec import SPACE, Slice, mix, slices, sums, table_of, windows

#: The bound on labelled rows that training sees.
MAX_ROWS = 4000
FEATURES = Features(bits=18, word_sizes=(1, 2), char_sizes=(4,))
#: A document is kept if its probability of good quality is this or more.
KEEP_SCORE = 0.35
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_SYMBOLS = table_of(b"#*$%&|<>")


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, features: Features, max_rows: int, extra=None) -> DataFrame:
    """(key, y, fold, slots, counts, …) of at most ``max_rows`` labelled documents.  ``extra(texts)`` may give
    a list of further sparse rows for each text, for example what swapped terms change."""
    marks = take(labels, doc_id="doc_id", y=label).filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = hashed_sample(marks.withColumn("fold", (crc % 5).cast("int")), max_rows, "doc_id")
    pairs = take(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen), "doc_id")  # bounded by max_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = column(batch, "text")
            got = features.rows(texts)
            further = extra(texts) if extra else [[] for _ in got]
            blobs = lambda rows, i, kind: [r[i].astype(kind).tobytes() for r in rows]
            own = [pa.array(blobs(got, i, kind), pa.binary()) for i, kind in enumerate(("<i4", "<f4"))]
            more = [pa.array([blobs(rows, i, kind) for rows in further], pa.list_(pa.binary())) for i, kind in enumerate(("<i4", "<f4"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("y"), batch.column("fold"), *own, *more], ["key", "y", "fold", "slots", "counts", "slots2", "counts2"])

    return pairs.mapInArrow(run, "key string, y int, fold int, slots binary, counts binary, slots2 array<binary>, counts2 array<binary>")


def train(rows: DataFrame, features: Features, prior: float, pair_weight: float = 0.0, calibration_fold: int = 1) -> Model:
    """Fit on all folds but one, calibrate on that one."""
    every, changes, y, fold = Collected(), Collected(), [], []
    # in a fixed order, so that the same rows always make the same model; a row's arrays are taken over as it comes
    for r in rows.orderBy("key", "slots", "counts").toLocalIterator():
        if r["fold"] != calibration_fold:
            for slots, counts_ in zip(r["slots2"], r["counts2"], strict=True):
                changes.add(slots, counts_)
        every.add(r["slots"], r["counts"])
        y.append(r["y"])
        fold.append(r["fold"])
    every, changes = every.rows(), changes.rows()
    try:
        return _trained(every, changes, np.array(y, int), np.array(fold, int), features, prior, pair_weight, calibration_fold)
    finally:
        del every, changes
        give_back()


def _trained(every: Rows, changes: Rows, y: np.ndarray, fold: np.ndarray, features: Features, prior: float, pair_weight: float, calibration_fold: int) -> Model:
    fitted = fold != calibration_fold
    if not len(y) or len(set(y[fitted])) < 2:
        p = min(max(((y == 1).sum() + 2 * prior) / (len(y) + 2), 1e-6), 1 - 1e-6)
        return Model(features, np.zeros(1 << features.bits, np.float32), float(np.log(p / (1 - p))))
    w, b = fit(every, y, features.bits, use=fitted, changes=changes, change_weight=pair_weight)
    held, margin = ~fitted, every.margins(w, b)
    a, c = platt(margin[held], y[held]) if len(set(y[held])) == 2 else (1.0, 0.0)
    return Model(features, w.astype(np.float32), b, a, c, {"rows": int(len(y)), "calibrated_on": int(held.sum()), "pairs": len(changes)})


def quality_model(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, features: Features = FEATURES) -> Model:
    return train(labelled_rows(docs, labels, "quality", features, max_rows), features, prior=0.9)


def _twice(key: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def counts(s: Slice) -> dict[str, np.ndarray]:
    """The counted rules of each text of a slice."""
    start, end = s.spans(~SPACE)
    words = s.bounds(start)
    text = np.arange(s.n, dtype=np.uint64)
    chars = np.r_[0, np.cumsum((s.buf & 0xC0) != 0x80)]
    # lines with a word that equal an earlier one
    a, b, before = s.lines()
    full = np.searchsorted(start, b) > np.searchsorted(start, a)
    owner = np.repeat(text, np.diff(before))
    a, b = a[full], b[full]
    keys = np.stack([s.hashes(a, b), s.hashes(a, b, seed=1), (b - a).astype(np.uint64), owner[full]])
    order = np.lexsort(keys)
    again = np.zeros(len(a), bool)
    again[order[1:]] = (keys[:, order[1:]] == keys[:, order[:-1]]).all(axis=0)
    dup_lines = np.bincount(owner[full][again].astype(np.int64), minlength=s.n)
    # words inside three-word windows that occur twice or more
    h, first = windows(s.hashes(start, end), words, 3)
    owner = np.repeat(text, np.diff(first))
    twice = np.flatnonzero(_twice(mix(h + mix(owner + np.uint64(1)))))
    at = words[:-1][owner[twice].astype(np.int64)] + twice - first[:-1][owner[twice].astype(np.int64)]
    hit = np.zeros(len(start) + 3, bool)
    for k in range(3):
        hit[at + k] = True
    return {"n_words": np.diff(words), "word_chars": sums(chars[end] - chars[start], words), "n_symbols": s.counts(np.flatnonzero(_SYMBOLS[s.buf])),
            "n_dup_lines": dup_lines, "n_repeat_words": sums(hit[:len(start)].astype(np.int64), words)}


def judge(texts: pa.Array, model: Model, keep_score: float) -> dict[str, np.ndarray]:
    parts = [counts(s) for s in slices(texts)]
    out = {k: np.concatenate([p[k] for p in parts]).astype(np.int64) for k in parts[0]}
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    out["score"] = model.scores(texts)
    out["kept"] = ~out["base_failed"] & (out["score"] >= keep_score)
    return out


def quality_report(docs: DataFrame, labels: DataFrame, keep_score: float = KEEP_SCORE, max_rows: int = MAX_ROWS) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, score and kept."""
    own = take(docs, doc_id="doc_id", text="text")
    model = docs.sparkSession.sparkContext.broadcast(quality_model(docs, labels, max_rows))
    schema = T.StructType([own.schema["doc_id"], *T._parse_datatype_string("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                got = judge(column(batch, "text"), model.value, keep_score)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(got[k]) for k in schema.names[1:]]], schema.names)

    return own.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, keep_score: float = KEEP_SCORE, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents, all columns, that pass the rules and the classifier."""
    names = docs.columns
    plain = docs.toDF(*[f"_{i}" for i in range(len(names))])
    text = f"_{names.index('text')}"
    model = docs.sparkSession.sparkContext.broadcast(quality_model(docs, labels, max_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(judge(column(batch, text), model.value, keep_score)["kept"]))

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counted rules and the classifier's verdict on every document."""
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
