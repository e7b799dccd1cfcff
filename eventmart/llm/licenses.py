"""License scans: a trained paragraph classifier, confirmed by comparison with templates.

1. Paragraphs are the lines of a text that hold a word.
2. A softmax regression over hashed words and word pairs is trained on the driver: on variations of the
   templates below (words dropped, capitals, comment signs, text around them), on licence-like sentences of no known
   family (class ``unknown``), and on ordinary paragraphs from a bounded sample of the
   documents (class ``none``).  A held-out part sets the temperature, so that probabilities are calibrated.
3. Every paragraph of every document is scored in Arrow batches.  A family needs ``MIN_PROBABILITY``; a
   licence-like paragraph below it is ``unknown``.
4. A predicted family is confirmed if the word pairs of one of its templates are found in the paragraph to at least
   ``MIN_SIMILARITY``; without that it is reported as ``unknown``, with the guess beside it.

Defined results: a null or empty text has no paragraphs and no findings; rows that repeat an id are scanned one by
one; an empty table gives an empty table (the classifier then knows templates only); other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import column, hashed_sample, table, take
from eventmart.llm.textvec import SPACE, mix, slices, windows

#: Public licence notices by family (fixed values).
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "SPDX-License-Identifier: Apache-2.0"],
    "mit": ["Released under the MIT License.", "This project is licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "SPDX-License-Identifier: MIT"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "You should have received a copy of the GNU General Public License along with this program.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "SPDX-License-Identifier: LGPL-2.1-only"],
    "bsd": ["Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "SPDX-License-Identifier: BSD-3-Clause"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc0": ["This work is dedicated to the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights", "SPDX-License-Identifier: CC0-1.0"],
}
#: Sentences about terms of use that name no family (fixed values).
UNKNOWN = ["All rights reserved.", "See the LICENSE file for the terms.", "Licensed under the terms of the agreement.", "This work is licensed under a proprietary license.", "Use of this software is subject to the license agreement.", "Distributed under a custom license, version 1.0.", "Copyright reserved by the author; redistribution is not permitted.", "You may not use this work without a license from the owner.", "Released under the house license of the publisher."]
CLASSES = ("none", "unknown", *TEMPLATES)
BITS = 15
MIN_PROBABILITY = 0.6
MIN_SIMILARITY = 0.6
#: The bound on ordinary paragraphs in training, taken from so many documents.
MAX_ORDINARY, MAX_DOCUMENTS = 3000, 400


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _pairs(text: str) -> set[tuple[str, ...]]:
    w = _words(text)
    return {tuple(w[i:i + 2]) for i in range(max(1, len(w) - 1))} if w else set()


_TEMPLATE_PAIRS = {k: [_pairs(t) for t in v] for k, v in TEMPLATES.items()}


def similarity(text: str, family: str) -> float:
    """The largest share of a template's word pairs that the text holds."""
    own = _pairs(text)
    return max((len(own & t) / len(t) for t in _TEMPLATE_PAIRS.get(family, ())), default=0.0)


_WORD_BYTE = np.array([0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


def _line_features(s) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Line starts, ends, lines before each text; slot and line of each distinct n-gram, by line."""
    start, end, before = s.lines()
    a, b = s.spans(_WORD_BYTE)
    h = s.hashes(a, b)
    line = np.searchsorted(start, a, "right") - 1
    shift = np.uint64(64 - BITS)
    slots, owner = [(mix(h + np.uint64(1)) >> shift).astype(np.int32)], [line]
    if len(h) > 1:
        two, _ = windows(h, np.array([0, len(h)]), 2)
        same = line[1:] == line[:-1]
        slots.append((mix(two[same] + np.uint64(2)) >> shift).astype(np.int32))
        owner.append(line[1:][same])
    # an n-gram counts once a line
    key = np.unique(np.concatenate(owner).astype(np.int64) << BITS | np.concatenate(slots))
    return start, end, before, key & ((1 << BITS) - 1), key >> BITS


def _margins(weights: np.ndarray, bias: np.ndarray, slots: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    size = np.maximum(np.bincount(owner, minlength=n), 1)
    total = np.stack([np.bincount(owner, weights[k][slots], n) for k in range(len(bias))], axis=1)
    return total / np.sqrt(size)[:, None] + bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _examples(ordinary: list[str], seed: int = 11, copies: int = 24) -> tuple[list[str], np.ndarray]:
    """Training paragraphs and their classes."""
    rng = np.random.default_rng(seed)
    texts, y = [], []
    for k, name in enumerate(CLASSES[1:], 1):
        for t in UNKNOWN if name == "unknown" else TEMPLATES[name]:
            for c in range(copies):
                w = [x for x in t.split(" ") if c == 0 or rng.random() > 0.08] or t.split(" ")
                x = " ".join(w)
                x = (x, x.upper(), x.lower(), f"# {x}", f"// {x}", f"* {x}")[int(rng.integers(6)) if c else 0]
                if ordinary and c % 3 == 2:
                    x = f"{x} {' '.join(ordinary[int(rng.integers(len(ordinary)))].split(' ')[:6])}"
                texts.append(x)
                y.append(k)
    texts += ordinary
    y += [0] * len(ordinary)
    return texts, np.array(y)


class Classifier:
    def __init__(self, ordinary: list[str], steps: int = 200):
        texts, y = _examples(ordinary or ["A sentence of ordinary words.", "Another one."])
        slots, owner = [], []
        for i, t in enumerate(texts):
            s = next(iter(slices(pa.array([t.replace("\n", " ")]), lower=True)))
            *_, slot, line = _line_features(s)
            slots.append(slot)
            owner.append(np.full(len(slot), i))
        slots, owner, n, k = np.concatenate(slots), np.concatenate(owner), len(texts), len(CLASSES)
        held = np.arange(n) % 5 == 4
        weight = np.where(held, 0, 1 / np.maximum(np.bincount(y, minlength=k), 1)[y])
        weight = weight / weight.sum()
        value = 1 / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1))[owner]
        self.weights, self.bias = np.zeros((k, 1 << BITS)), np.zeros(k)
        target = np.eye(k)[y]
        m, v = np.zeros((k, (1 << BITS) + 1)), np.zeros((k, (1 << BITS) + 1))
        for t in range(1, steps + 1):
            pull = (_softmax(_margins(self.weights, self.bias, slots, owner, n)) - target) * weight[:, None]
            g = np.stack([np.append(np.bincount(slots, value * pull[owner, c], 1 << BITS) + 1e-5 * self.weights[c], pull[:, c].sum()) for c in range(k)])
            m = 0.9 * m + 0.1 * g
            v = 0.99 * v + 0.01 * g * g
            step = 0.3 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8) * min(1.0, 2 * (1 - t / (steps + 1)))
            self.weights -= step[:, :-1]
            self.bias -= step[:, -1]
        margin = _margins(self.weights, self.bias, slots, owner, n)[held]
        loss = lambda heat: -np.log(np.maximum(_softmax(margin / heat)[np.arange(held.sum()), y[held]], 1e-12)).mean()
        heat = min(np.geomspace(0.5, 4, 25), key=loss)
        self.weights, self.bias = (self.weights / heat).astype(np.float32), self.bias / heat

    def probabilities(self, s) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Line starts, ends, lines before each text, and class probabilities of each line."""
        start, end, before, slots, owner = _line_features(s)
        p = _softmax(_margins(self.weights, self.bias, slots, owner, len(start)))
        p[np.bincount(owner, minlength=len(start)) == 0] = np.eye(len(CLASSES))[0]
        return start, end, before, p


def classifier(docs: DataFrame) -> Classifier:
    """Trained with ordinary paragraphs of at most ``MAX_DOCUMENTS`` documents, chosen by a hash."""
    some = hashed_sample(docs.filter("text is not null"), MAX_DOCUMENTS, "doc_id", "text")
    lines = some.select(F.explode(F.slice(F.split("text", "\n", -1), 1, 50)).alias("line")).filter("length(trim(line)) between 1 and 2000")
    ordinary = [r["line"] for r in lines.distinct().orderBy(F.xxhash64("line"), "line").limit(4 * MAX_ORDINARY).collect()]
    plain = [x for x in ordinary if max(similarity(x, f) for f in TEMPLATES) < 0.3 and not {"license", "licensed", "licence", "licenced", "copyright"} & set(_words(x))]
    return Classifier(plain[:MAX_ORDINARY])


_FOUND = "license string, guess string, probability double, similarity double, confirmed boolean, start long, end long"


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: doc_id, n_paragraphs, licenses (distinct, sorted) and findings, with byte ranges of the lines."""
    own = take(docs, doc_id=id_column, text=text_column)
    model = docs.sparkSession.sparkContext.broadcast(classifier(own))
    schema = T.StructType([own.schema["doc_id"], *T._parse_datatype_string(f"n_paragraphs long, licenses array<string>, findings array<struct<{_FOUND.replace(' ', ':').replace(',:', ',')}>>").fields])
    found_type = pa.list_(pa.struct([("license", pa.string()), ("guess", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, findings = [], []
            for s in slices(column(batch, "text"), lower=True):
                start, end, before, p = model.value.probabilities(s)
                words = s.spans(~SPACE)[0]
                full = np.searchsorted(words, end) > np.searchsorted(words, start)
                n += np.diff(np.r_[0, np.cumsum(full)][before]).tolist()
                own_findings: list[list[dict]] = [[] for _ in range(s.n)]
                for line in np.flatnonzero(1 - p[:, 0] >= MIN_PROBABILITY):
                    text = int(np.searchsorted(before, line, "right") - 1)
                    best = int(p[line, 2:].argmax()) + 2
                    words_of = s.buf[start[line]:end[line]].tobytes().decode()
                    alike = similarity(words_of, CLASSES[best])
                    sure = bool(p[line, best] >= MIN_PROBABILITY and alike >= MIN_SIMILARITY)
                    own_findings[text].append({"license": CLASSES[best] if sure else "unknown", "guess": CLASSES[best], "probability": float(p[line, best]), "similarity": alike, "confirmed": sure, "start": int(start[line] - s.offs[text]), "end": int(end[line] - s.offs[text])})
                findings += own_findings
            names = [sorted({f["license"] for f in x}) for x in findings]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(findings, found_type)], schema.names)

    return own.mapInArrow(run, schema)


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence families named in every document."""
    return scan(table(spark, sf_dir, "documents"))
