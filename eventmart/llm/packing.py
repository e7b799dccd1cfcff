"""Best-fit packing of token sequences by a configuration linear program.

1. Texts are tokenized; a document longer than a sequence is cut into full pieces and a rest.  Pieces are
   written once, each with its rank among its task's pieces of the same length.
2. The histogram of piece lengths (at most ``capacity`` rows, whatever the input) goes to the driver.
   Lengths are rounded up to classes of ``UNIT`` tokens.  The linear program has one unknown per
   configuration, the classes of one sequence; the cover of every class has to reach its count.  It is
   solved by multiplicative weights: knapsack dynamic programming prices the best
   configuration under the class weights, a share of it is bought, and the weights of what it covers fall.
3. The amounts are rounded down to whole sequences.  Pieces left over, less than one sequence's worth for
   each configuration, are placed with exact lengths, longest first, each where it fits best.
4. The layout, a list of intervals over piece ranks, is bounded by the number of configurations.  It
   goes to the tasks, which look up sequence and place of every piece by its rank.  Ranks come from counts by
   task and length, so that a length that most pieces share is never gathered in one task.

Defined results: a null or empty text is a document without ids of its own, here just the end id; rows
that repeat a doc_id are packed one by one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import stage, table, take
from eventmart.llm.tokens import encoder, texts_of

#: Lengths are planned in classes of so many tokens.
UNIT = 4
#: The share of the sequences that one step of the weights buys at most.
STEP = 1 / 400


def pieces_of(docs: DataFrame, tokenizer_path: str, kind: str, capacity: int, end_id: int, with_ids: bool = False, literal: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, rank[, ids]) of each piece."""
    fields = [docs.schema["doc_id"], *T._parse_datatype_string("piece int, start long, length long, ids_crc32 long, task int, rank long").fields]
    schema = T.StructType([*fields, T.StructField("ids", T.BinaryType())] if with_ids else fields)
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, seen = encoder(tokenizer_path, kind, literal), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        try:
            for batch in batches:
                owner, out, blobs = [], [], []
                for i, ids in enumerate(enc.encode(texts_of(batch.column("text")))):
                    ids = memoryview(ids + end)
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at: at + 4 * capacity]
                        length = len(part) // 4
                        owner.append(i)
                        out.append((piece, at // 4, length, zlib.crc32(part), task, seen[length]))
                        seen[length] += 1
                        if with_ids:
                            blobs.append(bytes(part))
                if owner:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(owner)), *columns, *([pa.array(blobs, pa.binary())] if with_ids else [])], schema.names)
        finally:
            enc.forget()

    return docs.mapInArrow(run, schema)


def best_configuration(weights: np.ndarray, sizes: np.ndarray, room: int) -> dict[int, int]:
    """Knapsack: copies of each class whose weights sum to the most within ``room`` units.
    ``sizes`` ascending; best[r] = the most that r units can hold."""
    best, chosen = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        fit = bisect.bisect_right(sizes, r) if r < sizes[-1] else len(sizes)
        best[r], chosen[r] = best[r - 1], -1
        if fit:
            value = weights[:fit] + best[r - sizes[:fit]]
            k = int(value.argmax())
            if value[k] > best[r] + 1e-15:
                best[r], chosen[r] = value[k], k
    out: dict[int, int] = {}
    r = room
    while r > 0:
        k = int(chosen[r])
        if k < 0:
            r -= 1
            continue
        out[k] = out.get(k, 0) + 1
        r -= int(sizes[k])
    return out


def solve(sizes: np.ndarray, counts: np.ndarray, room: int, step: float = STEP) -> dict[tuple, float]:
    """Amount of each configuration ((class, copies), …) so that every class is covered exactly."""
    left, amounts = counts.astype(float), {}
    weights = sizes / room
    total = max(1.0, float(sizes @ counts) / room)
    while (open_ := np.flatnonzero(left > 1e-9)).size:
        config = best_configuration(weights[open_], sizes[open_], room)
        config = {int(open_[k]): n for k, n in config.items()}
        ks, ns = np.array(list(config)), np.array(list(config.values()))
        buy = min(max(1.0, step * total), float((left[ks] / ns).min()))
        key = tuple(sorted(config.items(), reverse=True))
        amounts[key] = amounts.get(key, 0.0) + buy
        left[ks] = np.maximum(left[ks] - ns * buy, 0)
        weights[ks] *= np.exp(-0.5 * ns * buy / counts[ks])
    return amounts


@dataclass
class Layout:
    """Pieces in the order of (class, length, rank); interval i begins at piece ``start[i]`` and fills sequences
    ``sequence[i], sequence[i] + 1, …`` with ``copies[i]`` pieces each."""
    base: np.ndarray        # by length: number of the first piece of that length
    start: np.ndarray
    sequence: np.ndarray
    copies: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and number of each piece; pieces of a sequence lie in the order of their numbers."""
        number = self.base[length] + rank
        i = np.searchsorted(self.start, number, "right") - 1
        return self.sequence[i] + (number - self.start[i]) // self.copies[i], number


def lay_out(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> Layout:
    """From the histogram of lengths."""
    unit = UNIT if capacity % UNIT == 0 else 1
    room, klass = capacity // unit, -(-lengths // unit)
    order = np.lexsort((lengths, klass))
    lengths, counts, klass = lengths[order], counts[order], klass[order]
    base = np.zeros(capacity + 1, np.int64)
    base[lengths] = np.r_[0, np.cumsum(counts)[:-1]] if len(counts) else []
    sizes, first = np.unique(klass, return_index=True)
    demand = np.add.reduceat(counts, first) if len(counts) else counts
    at = np.r_[0, np.cumsum(demand)].astype(np.int64)       # first piece of each class
    used = at[:-1].copy()
    start, sequence, copies, n = [], [], [], 0
    for config, amount in sorted(solve(sizes, demand, room).items(), key=lambda x: -x[1]):
        whole = min(int(amount + 1e-6), *(int((at[k + 1] - used[k]) // c) for k, c in config))
        if whole:
            for k, c in config:
                start.append(int(used[k]))
                sequence.append(n)
                copies.append(c)
                used[k] += whole * c
            n += whole
    # what rounding left, longest first, each into the fullest sequence that takes it
    length_at = np.r_[0, np.cumsum(counts)]
    rest = [(int(p), int(lengths[np.searchsorted(length_at, p, "right") - 1])) for k in range(len(sizes)) for p in range(int(used[k]), int(at[k + 1]))]
    rooms, open_by_room = [], {}
    for piece, length in sorted(rest, key=lambda x: -x[1]):
        i = bisect.bisect_left(rooms, length)
        if i < len(rooms):
            free = rooms[i]
            s = open_by_room[free].pop()
            if not open_by_room[free]:
                del open_by_room[free]
                rooms.pop(i)
        else:
            free, s, n = capacity, n, n + 1
        if free > length:
            if free - length not in open_by_room:
                bisect.insort(rooms, free - length)
            open_by_room.setdefault(free - length, []).append(s)
        start.append(piece)
        sequence.append(s)
        copies.append(1)
    order = np.argsort(np.array(start, np.int64), kind="stable")
    return Layout(base, *(np.array(x, np.int64)[order] for x in (start, sequence, copies)), n)


def pack(docs: DataFrame, tokenizer_path: str, kind: str = "words", capacity: int = 4096, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False, literal: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]."""
    spark = docs.sparkSession
    pieces = stage(pieces_of(take(docs, doc_id=id_column, text=text_column), tokenizer_path, kind, capacity, end_id, with_ids, literal), "pieces")
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = by_task.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").collect()   # at most `capacity` rows
    layout = lay_out(np.array([r["length"] for r in histogram], np.int64), np.array([r["n"] for r in histogram], np.int64), capacity)
    shared = spark.sparkContext.broadcast(layout)
    before = by_task.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = pieces.join(before.select("task", "length", F.coalesce("before", F.lit(0)).alias("before")), ["task", "length"])
    ranked = ranked.select(*[c for c in pieces.columns if c not in ("task", "rank")], (F.col("rank") + F.col("before")).alias("rank"))
    kept = [f for f in ranked.schema.fields if f.name != "rank"]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("number", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, number = shared.value.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(sequence), pa.array(number)], schema.names)

    # a sequence has at most `capacity` pieces
    ahead = Window.partitionBy("sequence_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.mapInArrow(run, schema).withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("long"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 ids."""
    import public_tokenizers
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
