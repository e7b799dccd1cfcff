"""Toxicity: a hashed n-gram classifier trained with counterfactual identity swaps.

A logistic regression over hashed words and word beginnings (``hashed_lr``).  Counterfactuals are made for every
labelled training text (``counterfactuals``): where it mentions identity terms, the text with each of them swapped for every other of
its group (``TERM_GROUPS``); and, whether it does or not, one of its sentences with each term of one group put at one place, against
the sentence itself.  The fit adds ``pair_weight`` times the mean squared difference of the two margins to the loss, so that
a neutral mention of a group carries no score of its own.  ``Model.notes`` counts the pairs.  Training takes at
most ``max_rows`` labelled rows, none from the held-out fold (crc32 of the id as text, modulo 5, is 0); fold 1
calibrates the score.  All documents are scored whole in Arrow batches.  Only the text is an input.

Defined results: null and empty texts are scored as texts without words; labels that are null or without a
document are not used; of an id labelled more than once the largest label counts; without labels of both
classes every text gets one fixed low score; a null doc_id is not held out; rows that repeat a doc_id are
scored one by one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import column, table, take
from eventmart.llm.hashed_lr import Features, Model
from eventmart.llm.quality import labelled_rows, train

MAX_ROWS = 4000
FEATURES = Features(bits=18, word_sizes=(1,), head_sizes=(3, 4, 5, 6, 7), char_sizes=())
PAIR_WEIGHT = 5.0
THRESHOLD = 0.5
#: Terms that may stand for one another in a sentence, by group (English, German, French, Spanish).
TERM_GROUPS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "refugee", "citizen", "foreigner"), ("immigrants", "refugees", "citizens", "foreigners"),
    ("deaf", "blind", "disabled"), ("old", "young"),
    ("christen", "muslime", "juden", "hindus"), ("frau", "mann"), ("frauen", "männer"), ("ausländer", "flüchtling", "bürger"),
    ("chrétien", "musulman", "juif", "bouddhiste"), ("femme", "homme"), ("femmes", "hommes"), ("immigré", "réfugié", "citoyen"),
    ("cristiano", "musulmán", "judío", "budista"), ("mujer", "hombre"), ("mujeres", "hombres"), ("inmigrante", "refugiado", "ciudadano"),
)
_GROUP = {t: group for group in TERM_GROUPS for t in group}
_TERM = re.compile(r"\b(" + "|".join(sorted(map(re.escape, _GROUP), key=len, reverse=True)) + r")\b", re.IGNORECASE)
_SENTENCE = re.compile(r"[^.!?\n]*\w[^.!?\n]*")


def swapped(text: str, step: int = 1) -> str | None:
    """The text with each identity term replaced by the one ``step`` places on in its group; None if that changes nothing."""
    def other(found: re.Match) -> str:
        group = _GROUP[found[0].lower()]
        to = (group.index(found[0].lower()) + step) % len(group)
        return found[0] if group[to] == found[0].lower() else group[to]
    out = _TERM.sub(other, text)
    return out if out != text else None


def mentions(text: str) -> tuple[str, list[str]] | None:
    """One sentence of the text, and it again with each term of one group put before one of its words; None without words.
    Sentence, group and place follow from the text's checksum."""
    found = [m.span() for m in _SENTENCE.finditer(text)]
    if not found:
        return None
    crc = zlib.crc32(text.encode())
    start, end = found[crc % len(found)]
    words = text[start:end].split()
    at, group = crc // 7 % (len(words) + 1), TERM_GROUPS[crc // 3 % len(TERM_GROUPS)]
    return " ".join(words), [" ".join([*words[:at], term, *words[at:]]) for term in group]


def counterfactuals(features: Features):
    """For each text the differences between the sparse rows of its counterfactuals and those of what they were made from.  An
    added term makes a sentence longer, which damps all its words; both rows are damped alike here, so that only the term is penalised."""
    most = max(map(len, TERM_GROUPS))

    def pairs_of(text: str | None) -> list[tuple[str, str]]:
        if not text:
            return []
        planted = mentions(text)
        swaps = dict.fromkeys(swapped(text, k) for k in range(1, most)) if _TERM.search(text) else {}
        return [(text, x) for x in swaps if x is not None] + ([(planted[0], x) for x in planted[1]] if planted else [])

    def differences(texts: pa.Array) -> list[list]:
        out = []
        for text in texts.to_pylist():
            made = pairs_of(text)
            plain = list(dict.fromkeys(x for x, _ in made))
            rows = features.rows(pa.array([*plain, *[x for _, x in made]], pa.string())) if made else []
            source = dict(zip(plain, rows, strict=False))
            longer = [np.sqrt(len(y.split()) / max(len(x.split()), 1)) for x, y in made]
            out.append([difference((row[0], row[1] * scale), source[x]) for (x, _), row, scale in zip(made, rows[len(plain):], longer, strict=True)])
        return out
    return differences


def difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sparse row ``a - b``."""
    slots, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    values = np.bincount(at, np.concatenate([a[1], -b[1]]), len(slots))
    differs = np.abs(values) > 1e-6
    return slots[differs].astype(np.int32), values[differs].astype(np.float32)


def toxicity_model(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, features: Features = FEATURES, pair_weight: float = PAIR_WEIGHT) -> Model:
    """Learns from labels outside the held-out fold only."""
    learn = take(labels, doc_id="doc_id", toxic="toxic").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    return train(labelled_rows(docs, learn, "toxic", features, max_rows, counterfactuals(features)), features, prior=0.1, pair_weight=pair_weight)


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, pair_weight: float = PAIR_WEIGHT) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted."""
    own = take(docs, doc_id="doc_id", text="text")
    model = docs.sparkSession.sparkContext.broadcast(toxicity_model(docs, labels, max_rows, pair_weight=pair_weight))
    schema = T.StructType([own.schema["doc_id"], *T._parse_datatype_string("held_out boolean, score double, predicted int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = model.value.scores(column(batch, "text"))
                held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in batch.column("doc_id").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(held), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], schema.names)

    return own.mapInArrow(run, schema)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
