"""Language identification by cross-parsing entropy.

For each language, labelled text makes a suffix automaton.  A text is parsed against it: from the left, the longest match that
occurs in the language's text is one phrase, then the next begins.  Text in the language falls into few long phrases.  With
``c`` phrases, ``c * log2(n) / m`` (``n`` letters learned, ``m`` parsed) estimates the bits a letter costs in that language;
the language with the fewest such normalised phrases wins.

* Texts are lower-cased; every run of ASCII characters other than letters counts as one space.  Symbols are UTF-8 bytes.
* Learning takes at most ``max_rows`` labelled documents a language, those with the smallest hashes, and at most ``max_bytes``
  of them, a document longer than an eighth of that with pieces from all over it; all languages together take at most ``TOTAL_BYTES``.
* Whole texts are parsed, in segments of ``SEGMENT`` bytes.  Each segment begins a phrase, so that all segments
  of many texts are parsed side by side, a byte of each at a time, in numpy; a very long text is many segments.
* The automata lie end to end in one double array: state ``s`` has an edge for symbol ``a`` if ``check[base[s] + a]`` is
  ``s``.  It is built on the driver and broadcast; its size follows ``TOTAL_BYTES``.

``score`` compares the winner's phrases with those of the others, in units of what chance makes of such a count: 1 over the sum of
``exp(-z)``, so one language far ahead has a score near 1, and k equal ones 1/k.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is every text if nothing can be learned;
of equal languages the first by name wins; rows that repeat a doc_id are judged one by one; a null doc_id is not held out
and not learned from; an empty table gives an empty table; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import column, stage, table, take
from eventmart.llm.textvec import Slice, slices

#: Bounds on what is learned from: documents and bytes of a language, bytes of all.
MAX_ROWS = 64
MAX_BYTES = 48_000
TOTAL_BYTES = 2_000_000
#: Languages whose counts are broadcast.
MAX_BROADCAST = 10_000
#: Bytes that are parsed in a row.
SEGMENT = 512
_SPACE = 0x20
_CLASS = np.full(256, _SPACE, np.uint8)
_CLASS[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLASS[0x80:] = np.arange(0x80, 256)


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts)


def symbols(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """A slice's symbols, runs of spaces as one, and each text's bounds in them."""
    got = _CLASS[s.buf]
    space = got == _SPACE
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[s.offs[:-1][s.offs[:-1] < len(got)]] = True
    before = np.r_[0, np.cumsum(keep)]
    return got[keep], before[s.offs]


# -- suffix automata --------------------------------------------------------------------------------------
def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Edges of each state; state 0 is the root, and every path from it spells a substring."""
    edges, link, length = [{}], [-1], [0]
    last = 0
    for a in text:
        new = len(edges)
        edges.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and a not in edges[p]:
            edges[p][a] = new
            p = link[p]
        if p >= 0:
            q = edges[p][a]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(edges)
                edges.append(dict(edges[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = twin
                while p >= 0 and edges[p].get(a) == q:
                    edges[p][a] = twin
                    p = link[p]
        last = new
    return edges


def _double_array(edges: list[dict[int, int]], tries: int = 24) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base of each state; check and next of each cell.  States with many edges are placed first, in one of the next
    gaps or else at the end; those with one edge fill what is free."""
    n_cells = 768 + sum(len(e) + 256 * (len(e) > 1) for e in edges)
    check, target = np.full(n_cells, -1, np.int32), np.zeros(n_cells, np.int32)
    base = np.zeros(len(edges), np.int32)
    used = bytearray(n_cells)
    start = end = 256

    def put(s: int, at: int) -> None:
        base[s] = at
        for a, q in edges[s].items():
            used[at + a], check[at + a], target[at + a] = 1, s, q

    for s in sorted((s for s, e in enumerate(edges) if len(e) > 1), key=lambda s: -len(edges[s])):
        low, *rest = sorted(edges[s])
        start = at = used.find(0, start)
        for _ in range(tries):
            if not any(used[at - low + a] for a in rest):
                break
            at = used.find(0, at + 1)
        else:
            start = at = max(end, start)                 # these gaps are left to states with one edge
        put(s, at - low)
        end = max(end, at - low + max(rest) + 1)
    at = used.find(0, 256)
    for s, e in enumerate(edges):
        if len(e) == 1:
            put(s, at - next(iter(e)))
            at = used.find(0, at + 1)
    cells = int(np.flatnonzero(check >= 0).max(initial=0)) + 257
    return base, check[:cells], target[:cells]


@dataclass
class Parser:
    """Automata of all languages in one double array."""
    names: list[str]
    letters: np.ndarray            #: bytes learned, by language
    base: np.ndarray
    check: np.ndarray
    target: np.ndarray
    first: np.ndarray              #: state after a phrase's first byte, by language and byte; the last row of states has no edge

    @classmethod
    def of(cls, texts: dict[str, bytes]) -> Parser:
        names = sorted(texts)
        bases, checks, targets, firsts, states, cells = [], [], [], [], 0, 0
        for name in names:
            edges = suffix_automaton(texts[name])
            base, check, target = _double_array(edges)
            bases.append(base + cells)
            checks.append(np.where(check >= 0, check + states, -1))
            targets.append(target + states)
            firsts.append(np.array([edges[0].get(a, -states - 1) + states for a in range(256)]))
            states, cells = states + len(edges), cells + len(check)
        base, check = np.r_[*bases, 0], np.r_[*checks, np.full(256, -1)]
        first = np.where((f := np.stack(firsts)) >= 0, f, states)
        return cls(names, np.array([len(texts[x]) for x in names]), base.astype(np.int32), check.astype(np.int32), np.r_[*targets, np.zeros(256, int)].astype(np.int32), first.astype(np.int32))

    def phrases(self, codes: np.ndarray) -> np.ndarray:
        """Phrases by language of each segment; a column of ``codes`` is a segment, filled up with zeros."""
        count = np.zeros((len(self.names), codes.shape[1]), np.int32)
        state = np.full(count.shape, len(self.base) - 1, np.int32)
        for own in codes:
            cell = self.base[state] + own
            ahead = self.check[cell] == state
            state = np.where(ahead, self.target[cell], self.first[:, own])
            count += ~ahead
        return count - (codes == 0).sum(axis=0, dtype=np.int32)      # nothing goes on with a zero

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Phrases by language of each text, and each text's length in symbols."""
        out, sizes = np.zeros((len(self.names), len(texts)), np.int64), np.zeros(len(texts), np.int64)
        for s in slices(lowered(texts)):
            got, bounds = symbols(s)
            size = np.diff(bounds)
            parts = -(-size // SEGMENT)
            before = np.r_[0, np.cumsum(parts)]
            owner = np.repeat(np.arange(s.n), parts)
            start = bounds[owner] + (np.arange(before[-1]) - before[owner]) * SEGMENT
            for i in range(0, len(start), 4096):           # bounds the cells held at once
                a, ends = start[i:i + 4096], bounds[owner[i:i + 4096] + 1]
                at = a + np.arange(min(SEGMENT, (ends - a).max()))[:, None]
                codes = np.where(at < ends, got[np.minimum(at, len(got) - 1)], np.uint8(0))
                np.add.at(out, (slice(None), s.first + owner[i:i + 4096]), self.phrases(codes))
            sizes[s.first:s.first + s.n] = size
        return out, sizes

    def judge(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and bits a letter of each text."""
        count, size = self.counts(texts)
        norm = np.log2(np.maximum(self.letters, 2))[:, None]
        bits = count * norm
        best = bits.argmin(axis=0)
        least = np.take_along_axis(bits, best[None], 0)[0]
        spread = norm.max(initial=1) * np.sqrt(least / norm.max(initial=1) + 1)
        score = 1 / np.exp(-(bits - least) / spread).sum(axis=0)
        return best, score, least / np.maximum(size, 1)


# -- learning ---------------------------------------------------------------------------------------------
def _crc(c: Column) -> Column:
    return F.crc32(c.cast("string").cast("binary"))


def training_texts(docs: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> dict[str, bytes]:
    """For each language the symbols to learn, from documents outside the held-out fold."""
    own = take(docs, doc_id="doc_id", text="text", lang="lang").filter("doc_id is not null and text is not null and lang is not null").filter(_crc(F.col("doc_id")) % 3 != 1)
    counted = stage(own.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    if counted.count() <= MAX_BROADCAST:
        counted = F.broadcast(counted)                    # else rows would be dealt out by language
    # rows with large hashes are left out before their language's are ranked: some 8 * max_rows stay
    h = F.xxhash64("doc_id", F.lit(11))
    few = own.select("doc_id", "lang").join(counted, "lang").withColumn("h", h).filter(F.shiftrightunsigned("h", 11).cast("double") / 2.0 ** 53 < 8.0 * max_rows / F.col("n"))
    few = few.withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy("h", "doc_id"))).filter(F.col("place") <= max_rows).select("doc_id", "lang")
    share = max(256, max_bytes // 8)
    schema = "doc_id string, lang string, part binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[bytes] = []
            for s in slices(lowered(column(batch, "text"))):
                got, bounds = symbols(s)
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    size = b - a
                    if size > share:
                        cuts = np.linspace(a, b - share // 4, 4).astype(int)
                        parts.append(b" ".join(got[c:c + share // 4].tobytes() for c in cuts))
                    else:
                        parts.append(got[a:b].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("lang"), pa.array(parts, pa.binary())], ["doc_id", "lang", "part"])

    chosen = stage(few, "language-rows").dropDuplicates(["doc_id", "lang"])
    rows = own.withColumn("lang", F.col("lang").cast("string")).join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "text", "lang")  # max_rows a language
    got = sorted(tuple(r) for r in rows.mapInArrow(run, schema).toLocalIterator())
    out: dict[str, list[bytes]] = {}
    for _, lang, part in got:
        out.setdefault(lang, []).append(bytes(part))
    each = min(max_bytes, TOTAL_BYTES // max(len(out), 1))
    joined = {lang: b" ".join(sorted(parts, key=zlib.crc32))[:each] for lang, parts in out.items()}
    return {lang: t for lang, t in joined.items() if t.strip()}


def identify(docs: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, texts: dict[str, bytes] | None = None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score and bits_per_letter.  ``texts`` (symbols by language) stands for learning."""
    learned = training_texts(docs, max_rows, max_bytes) if texts is None else texts
    own = take(docs, doc_id="doc_id", text="text").withColumn("held_out", F.coalesce(_crc(F.col("doc_id")) % 3 == 1, F.lit(False)))
    if not learned:
        return own.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits_per_letter"))
    parser = docs.sparkSession.sparkContext.broadcast(Parser.of(learned))
    schema = T.StructType([own.schema["doc_id"], *T._parse_datatype_string("held_out boolean, lang_pred string, score double, bits_per_letter double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text = column(batch, "text")
            best, score, bits = parser.value.judge(text)
            no_letter = ~pc.match_substring_regex(text, r"\pL").to_numpy(zero_copy_only=False)
            lang = np.where(no_letter, "und", np.array(parser.value.names, object)[best])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(np.where(no_letter, 0.0, score)), pa.array(np.where(no_letter, 0.0, bits))], schema.names)

    return own.mapInArrow(run, schema)


def op11_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return identify(table(spark, sf_dir, "documents"))
