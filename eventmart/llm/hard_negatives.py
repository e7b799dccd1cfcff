"""Hard-negative mining: exact search in windows of the inner product, pruned by a GNAT-style tree.

Anchors look for their positives, the nearest rows of their label, and then, for each positive, for the nearest rows of other labels
whose score lies in a window below the positive's.

1. Components become integers, ``floor(scale * x)``, so scores are exact.  With one more component, ``sqrt(M - |x|^2)`` for the
   largest squared norm ``M``, all rows lie on a sphere, and for an anchor (with 0 there) the squared distance is
   ``|a|^2 + M - 2 score``: a window of scores is an annulus around the anchor.
2. The tree is fitted on at most ``max_sample`` rows, those with the smallest hashes.  A node has up to ``FANOUT`` split points, chosen far from each
   other; a row belongs to the nearest one (a hyperplane between any two).  Every row of the table then descends to its leaf,
   and each split point on the way stores the range of its distances to the rows of every sibling's subtree: counted over all
   rows, by task and merged.  Split points, ranges and leaf sizes follow the sample, and are broadcast.
3. An anchor visits a subtree unless some split point excludes it: with ``d`` from the anchor to the split point and a range
   ``[low, high]``, its rows are at ``max(d - high, low - d)`` or more, and ``d + high`` or less.  If that misses the annulus, the subtree is out.
4. Leaves are exact.  A leaf is cut into parts of about ``PART_ROWS`` rows by a hash, and anchors into slices of about
   ``SLICE_ANCHORS``; the rows of a part and the anchors of a slice that visit it meet in one group, whatever the size of the
   leaf.  Each gives at most as many rows an anchor as the result has; a ranked window keeps the first of them.
   Positives take two rounds: the anchor's own leaf, one part of it, bounds the radius of the search in all others.

Defined results: rows with a null id, label or vector, with a null or non-finite component, or with so large
components that a score might not fit 62 bits, take no part; of rows equal in id, label and vector one counts, other rows
that share an id are rows of their own, and follow each other by label and a hash of the vector; a shorter vector counts as
filled up with zeros; an anchor with no positive, or a positive with no row in its window, gives no row; an empty table gives an
empty table; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.llm.common import hashed_sample, stage, table, take

#: Rows that the tree is fitted on, split points of a node, and sample rows of a leaf, at most.
MAX_SAMPLE, FANOUT, LEAF_SAMPLE = 4096, 8, 48
#: Rows of a leaf's part and anchors of a slice, about.
PART_ROWS, SLICE_ANCHORS = 4096, 4096
_ROW = "row_id long, label long, tag long, vector binary"


# -- 1: rows ----------------------------------------------------------------------------------------------
def integer_rows(df: DataFrame, scale: int, id_column: str, label_column: str, vector_column: str, label: Callable[[Column, Column], Column] | None) -> DataFrame:
    """(row_id, label, tag, vector): the rows that take part, components as little-endian 64-bit integers."""
    own = take(df, row_id=id_column, label=label_column, vector=vector_column)
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    own = own.filter("row_id is not null and label is not null and vector is not null").filter(~bad)
    own = own.select(F.col("row_id").cast("long").alias("row_id"), F.col("label").cast("long").alias("label"), F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("vector"))
    own = own.filter(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x) < 2.0 ** 62)
    if label is not None:
        own = own.withColumn("label", label(F.col("row_id"), F.col("label")).cast("long"))
    own = own.withColumn("vector", F.transform("vector", lambda x: x.cast("long"))).dropDuplicates(["row_id", "label", "vector"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<i8")
            blobs = pa.array([flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("row_id", "label", "tag")], blobs], ["row_id", "label", "tag", "vector"])

    return stage(own.withColumn("tag", F.xxhash64("label", "vector")).mapInArrow(run, _ROW), "vectors")


def matrix(blobs: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of so many integers."""
    parts = blobs.to_pylist()
    if all(len(x) == 8 * width for x in parts):
        return np.frombuffer(b"".join(parts), "<i8").reshape(len(parts), width)
    out = np.zeros((len(parts), width), np.int64)
    for i, x in enumerate(parts):
        out[i, :len(x) // 8] = np.frombuffer(x, "<i8")
    return out


def inner(a: np.ndarray, b: np.ndarray, exact_floats: bool) -> np.ndarray:
    """Inner products of all rows, exact: by floats where every sum fits their 53 bits."""
    if exact_floats:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


# -- 2: the tree ------------------------------------------------------------------------------------------
@dataclass
class Node:
    """Split points on the sphere; ``child[i]`` is a node, or a leaf below zero; ``low`` and ``high``: distances from
    split point i to the rows of subtree j."""
    points: np.ndarray
    child: np.ndarray
    low: np.ndarray = field(default=None)
    high: np.ndarray = field(default=None)


@dataclass
class Tree:
    width: int
    top: float                     #: the largest squared norm
    nodes: list[Node]
    leaves: int
    parts: np.ndarray = field(default=None)

    @property
    def exact_floats(self) -> bool:
        return self.top < 2.0 ** 52

    def lifted(self, v: np.ndarray) -> np.ndarray:
        """Rows on the sphere."""
        x = v.astype(np.float64)
        return np.c_[x, np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0))]

    @property
    def slack(self) -> float:
        """More than rounding can move a distance."""
        return 1e-6 * (math.sqrt(self.top) + 1)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2 * x @ points.T
    return np.sqrt(np.maximum(square, 0))


def far_points(x: np.ndarray, n: int, least: float) -> np.ndarray:
    """Rows far from each other, more than ``least``: the first is far from the mean, each next the farthest from those before."""
    chosen = [int(distances(x, x.mean(axis=0)[None]).argmax())]
    near = distances(x, x[chosen])[:, 0]
    while len(chosen) < n and near.max() > least:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
    return np.array(chosen)


def fit_tree(sample: np.ndarray, width: int, top: float, fanout: int = FANOUT, leaf_sample: int = LEAF_SAMPLE) -> Tree:
    """Hyperplane tree of a sample of integer rows; without rows, one leaf."""
    tree = Tree(width, top, [], 0)
    x = tree.lifted(sample)

    def grow(own: np.ndarray) -> int:
        points = far_points(x[own], fanout, tree.slack) if len(own) > leaf_sample else np.zeros(0, int)
        if len(points) < 2:
            tree.leaves += 1
            return -tree.leaves
        node = Node(x[own[points]], np.zeros(len(points), np.int64))
        tree.nodes.append(node)
        number = len(tree.nodes) - 1
        nearest = distances(x[own], node.points).argmin(axis=1)
        for i in range(len(points)):
            node.child[i] = grow(own[nearest == i])
        return number

    grow(np.arange(len(x)))
    return tree


def descend(tree: Tree, v: np.ndarray, seen: list | None = None) -> np.ndarray:
    """Leaf of each row; ``seen`` gets (node, distances to its points, child taken) for ranges."""
    x, leaf = tree.lifted(v), np.zeros(len(v), np.int64)
    todo = [(0, np.arange(len(v)))] if tree.nodes else []
    while todo:
        number, own = todo.pop()
        node = tree.nodes[number]
        d = distances(x[own], node.points)
        nearest = d.argmin(axis=1)
        if seen is not None:
            seen.append((number, d, nearest))
        for i, child in enumerate(node.child.tolist()):
            part = own[nearest == i]
            if len(part) and child >= 0:
                todo.append((child, part))
            elif len(part):
                leaf[part] = -1 - child
    return leaf


def measured(rows: DataFrame, tree: Tree) -> tuple[DataFrame, Tree]:
    """Rows with their leaf, written; the tree with the ranges and leaf sizes of all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = descend(shared.value, matrix(batch.column("vector"), tree.width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32), pa.int32())], [*batch.schema.names, "leaf"])

    placed = stage(rows.mapInArrow(assign, f"{_ROW}, leaf int"), "leaves")
    sizes = np.zeros(max(tree.leaves, 1), np.int64)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        low = [np.full((len(n.points),) * 2, np.inf) for n in own.nodes]
        high = [np.full((len(n.points),) * 2, -np.inf) for n in own.nodes]
        for batch in batches:
            seen: list = []
            descend(own, matrix(batch.column("vector"), own.width), seen)
            for number, d, nearest in seen:
                for j in np.unique(nearest):
                    part = d[nearest == j]
                    low[number][:, j] = np.minimum(low[number][:, j], part.min(axis=0))
                    high[number][:, j] = np.maximum(high[number][:, j], part.max(axis=0))
        for number in range(len(own.nodes)):
            yield pa.RecordBatch.from_pydict({"node": pa.array([number], pa.int32()), "low": pa.array([low[number].ravel()], pa.list_(pa.float64())), "high": pa.array([high[number].ravel()], pa.list_(pa.float64()))})

    # one row a task and node; merged cell by cell
    found = placed.select("vector").mapInArrow(ranges, "node int, low array<double>, high array<double>")
    cells = found.select("node", F.posexplode(F.arrays_zip("low", "high")).alias("cell", "r")).groupBy("node", "cell").agg(F.min("r.low").alias("low"), F.max("r.high").alias("high"))
    for node in tree.nodes:
        node.low, node.high = np.full((len(node.points),) * 2, np.inf), np.full((len(node.points),) * 2, -np.inf)
    for r in cells.toLocalIterator():
        tree.nodes[r["node"]].low.flat[r["cell"]], tree.nodes[r["node"]].high.flat[r["cell"]] = r["low"], r["high"]
    for r in placed.groupBy("leaf").count().toLocalIterator():
        sizes[r["leaf"]] = r["count"]
    tree.parts = np.maximum(1, -(-sizes // PART_ROWS))
    return placed, tree


def surviving(tree: Tree, v: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, leaf) pairs left when query i looks for rows at distances near[i] to far[i]."""
    x = np.c_[v.astype(np.float64), np.zeros(len(v))]
    if not tree.nodes:
        return np.arange(len(v)), np.zeros(len(v), np.int64)
    query, leaf, todo = [], [], [(0, np.arange(len(v)))]
    while todo:
        number, own = todo.pop()
        node = tree.nodes[number]
        d = distances(x[own], node.points)[:, :, None]                   # query, split point, subtree
        least = np.maximum(d - node.high, node.low - d).max(axis=1)
        most = (d + node.high).min(axis=1)
        keep = (least <= far[own, None] + tree.slack) & (most >= near[own, None] - tree.slack)
        for i, child in enumerate(node.child.tolist()):
            part = own[keep[:, i]]
            if len(part) and child >= 0:
                todo.append((child, part))
            elif len(part):
                query.append(part)
                leaf.append(np.full(len(part), -1 - child))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(query or none), np.concatenate(leaf or none)


def radius(tree: Tree, v: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Distance on the sphere from each query to rows of that score."""
    x = v.astype(np.float64)
    return np.sqrt(np.maximum((x * x).sum(axis=1) + tree.top - 2.0 * score, 0))


# -- 4: meeting of rows and anchors -----------------------------------------------------------------------
_VISIT = "leaf int, slice int, a_id long, a_label long, a_tag long, a_vector binary, low array<long>, high array<long>, p_id array<long>, p_tag array<long>"


def _parts(parts: np.ndarray) -> Column:
    """Number of parts of a row's leaf, a literal for each of the tree's leaves."""
    return F.lit(1) if parts.max(initial=1) == 1 else F.element_at(F.array(*[F.lit(int(n)) for n in parts]), F.col("leaf") + 1)


def _meet(placed: DataFrame, visits: DataFrame, parts: np.ndarray, meeting, schema: str, first_only: bool = False) -> DataFrame:
    """Groups of (leaf, part, slice): the rows of the part with the anchors of the slice that visit the leaf.
    ``first_only``: of each leaf only the first part."""
    rows = placed.withColumn("part", F.pmod(F.xxhash64("row_id", "tag"), _parts(parts)).cast("int"))
    each = F.array(F.lit(0)) if first_only else F.sequence(F.lit(0), _parts(parts) - 1)
    used = visits.select("leaf", "slice").distinct().withColumn("part", F.explode(each))
    rows = rows.join(used, ["leaf", "part"])                 # parts of leaves that nobody visits stay where they are
    rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])
    seen = visits.withColumn("part", F.explode(each))
    return seen.groupBy("leaf", "part", "slice").cogroup(rows.groupBy("leaf", "part", "slice")).applyInArrow(meeting, schema)


def _table(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()


def _positives_meeting(tree_of, k: int):
    names = ["a_id", "a_tag", "p_id", "p_tag", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 5
        if left.num_rows and right.num_rows:
            tree = tree_of.value
            ids, tags, labels = (_table(right, c) for c in ("row_id", "tag", "label"))
            rows = matrix(right.column("vector").combine_chunks(), tree.width)
            found: list[list] = [[] for _ in names]
            order = np.lexsort((tags, ids))
            a_id, a_tag, a_label = (_table(left, c) for c in ("a_id", "a_tag", "a_label"))
            least = left.column("low").combine_chunks().flatten().to_numpy()
            for i in range(0, left.num_rows, 256):
                a = slice(i, i + 256)
                score = inner(matrix(left.column("a_vector").slice(i, 256).combine_chunks(), tree.width), rows[order], tree.exact_floats)
                fits = (a_label[a, None] == labels[order]) & ~((a_id[a, None] == ids[order]) & (a_tag[a, None] == tags[order])) & (score >= least[a, None])
                for q in range(len(score)):
                    own = np.flatnonzero(fits[q])
                    own = own[np.argsort(-score[q, own], kind="stable")[:k]]
                    for c, x in zip(found, (np.full(len(own), a_id[i + q]), np.full(len(own), a_tag[i + q]), ids[order][own], tags[order][own], score[q, own]), strict=True):
                        c.append(x)
            out = [np.concatenate(c) for c in found]
        return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in out], names)

    return run, "a_id long, a_tag long, p_id long, p_tag long, score long"


def _negatives_meeting(tree_of, k: int):
    names = ["a_id", "a_tag", "p_id", "p_tag", "n_id", "n_tag", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 7
        if left.num_rows and right.num_rows:
            tree = tree_of.value
            order = np.lexsort((_table(right, "tag"), _table(right, "row_id")))
            ids, tags, labels = (_table(right, c)[order] for c in ("row_id", "tag", "label"))
            rows = matrix(right.column("vector").combine_chunks(), tree.width)[order]
            found: list[list] = [[] for _ in names]
            a_id, a_tag, a_label = (_table(left, c) for c in ("a_id", "a_tag", "a_label"))
            windows = list(zip(*[left.column(c).to_pylist() for c in ("low", "high", "p_id", "p_tag")], strict=True))
            for i in range(0, left.num_rows, 256):
                score = inner(matrix(left.column("a_vector").slice(i, 256).combine_chunks(), tree.width), rows, tree.exact_floats)
                for q in range(len(score)):
                    low, high, p_id, p_tag = windows[i + q]
                    own = np.flatnonzero((score[q] >= min(low)) & (score[q] <= max(high)) & (labels != a_label[i + q]))
                    own = own[np.argsort(-score[q, own], kind="stable")]
                    falling = -score[q, own]
                    for j in range(len(low)):
                        first = int(np.searchsorted(falling, -high[j], "left"))
                        last = min(first + k, int(np.searchsorted(falling, -low[j], "right")))
                        best = own[first:last]
                        n = len(best)
                        for c, x in zip(found, (np.full(n, a_id[i + q]), np.full(n, a_tag[i + q]), np.full(n, p_id[j]), np.full(n, p_tag[j]), ids[best], tags[best], score[q, best]), strict=True):
                            c.append(x)
            out = [np.concatenate(c) for c in found]
        return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in out], names)

    return run, "a_id long, a_tag long, p_id long, p_tag long, n_id long, n_tag long, score long"


def _ranked(found: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """The first k rows of each key: every task keeps k of its own before the exchange."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score"), *order))
    return found.withColumn("place", place).filter(F.col("place") <= k)


def mine(df: DataFrame, anchor: Callable[[Column], Column], positives: int = 5, negatives: int = 10, window: tuple[int, int, int] = (30, 90, 100), scale: int = 256,
         id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding", label: Callable[[Column, Column], Column] | None = None, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of each anchor's first ``positives``
    and the first ``negatives`` rows of other labels with ``window[0] * p <= window[2] * n <= window[1] * p``.

    ``anchor(id)`` says which rows are anchors; ``label(id, label)`` may give other labels."""
    spark = df.sparkSession
    rows = integer_rows(df, scale, id_column, label_column, vector_column, label)
    sizes = rows.select(F.max(F.octet_length("vector")).alias("bytes")).first()
    width = (sizes["bytes"] or 0) // 8

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"), width)
            yield pa.RecordBatch.from_pydict({"norm": pa.array([int((x * x).sum(axis=1).max(initial=0))], pa.int64())})

    top = rows.select("vector").mapInArrow(norms, "norm long").agg(F.max("norm")).first()[0] or 0
    got = hashed_sample(rows, max_sample, "row_id", "tag").select("vector").collect()                 # max_sample rows
    sample = matrix(pa.array([bytes(r["vector"]) for r in got], pa.binary()), width)
    placed, tree = measured(rows, fit_tree(sample, width, float(top)))
    shared = spark.sparkContext.broadcast(tree)
    anchors = placed.filter(anchor(F.col("row_id"))).select(F.col("row_id").alias("a_id"), F.col("label").alias("a_label"), F.col("tag").alias("a_tag"), F.col("vector").alias("a_vector"), F.col("leaf").alias("own"))
    slices = max(1, math.ceil(anchors.count() / SLICE_ANCHORS))
    anchors = anchors.withColumn("slice", F.pmod(F.xxhash64("a_id", "a_tag", F.lit(3)), F.lit(slices)).cast("int"))
    empty = F.array().cast("array<long>")
    lowest = -(1 << 62)

    # positives, first in a part of the own leaf
    own_leaf = anchors.select(F.col("own").alias("leaf"), "slice", "a_id", "a_label", "a_tag", "a_vector", F.array(F.lit(lowest)).alias("low"), empty.alias("high"), empty.alias("p_id"), empty.alias("p_tag"))
    meeting, schema = _positives_meeting(shared, positives)
    near = _meet(placed, own_leaf, tree.parts, meeting, schema, first_only=True)
    bound = _ranked(near, ["a_id", "a_tag"], ["p_id", "p_tag"], positives).groupBy("a_id", "a_tag").agg(F.when(F.count("*") == positives, F.min("score")).alias("least"))
    reach = anchors.join(bound, ["a_id", "a_tag"], "left").withColumn("low", F.array(F.coalesce("least", F.lit(lowest)))).withColumn("high", F.array(F.lit(-lowest)))
    reach = reach.select("slice", "a_id", "a_label", "a_tag", "a_vector", "low", "high", empty.alias("p_id"), empty.alias("p_tag"))
    visits = stage(reach.mapInArrow(_visits(shared), _VISIT), "positive-visits")
    found = _ranked(_meet(placed, visits, tree.parts, meeting, schema), ["a_id", "a_tag"], ["p_id", "p_tag"], positives)
    found = stage(found, "positives")

    # negatives, in the annuli of all positives' windows
    low, high, whole = window
    bounds = found.select("a_id", "a_tag", "p_id", "p_tag", "score", F.ceil(F.lit(low).cast("decimal(38,0)") * F.col("score") / whole).cast("long").alias("low"), F.floor(F.lit(high).cast("decimal(38,0)") * F.col("score") / whole).cast("long").alias("high")).filter("low <= high")
    wanted = bounds.groupBy("a_id", "a_tag").agg(*[F.collect_list(c).alias(c) for c in ("low", "high", "p_id", "p_tag")])           # lists of one group, in one order
    wanted = anchors.join(wanted, ["a_id", "a_tag"]).select("slice", "a_id", "a_label", "a_tag", "a_vector", "low", "high", "p_id", "p_tag")
    visits = stage(wanted.mapInArrow(_visits(shared), _VISIT), "negative-visits")
    meeting, schema = _negatives_meeting(shared, negatives)
    best = _ranked(_meet(placed, visits, tree.parts, meeting, schema), ["a_id", "a_tag", "p_id", "p_tag"], ["n_id", "n_tag"], negatives)
    scores = found.select("a_id", "a_tag", "p_id", "p_tag", F.col("score").alias("positive_score"))
    out = best.join(scores, ["a_id", "a_tag", "p_id", "p_tag"])
    return out.select(F.col("a_id").alias("anchor_id"), F.col("p_id").alias("positive_id"), F.col("place").cast("int").alias("rank"), F.col("n_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _visits(shared):
    """Anchors with their windows, once for each leaf that any window leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                batch = whole.slice(i, 1024)
                tree = shared.value
                v = matrix(batch.column("a_vector"), tree.width)
                low, high = batch.column("low"), batch.column("high")
                owner = np.repeat(np.arange(len(v)), low.value_lengths().to_numpy())
                far = radius(tree, v[owner], low.flatten().to_numpy())
                near = radius(tree, v[owner], high.flatten().to_numpy())
                query, leaf = surviving(tree, v[owner], near, far)
                pair = np.unique(owner[query] * max(tree.leaves, 1) + leaf)
                at = pa.array(pair // max(tree.leaves, 1))
                yield pa.RecordBatch.from_arrays([pa.array((pair % max(tree.leaves, 1)).astype(np.int32)), *[batch.column(c).take(at) for c in batch.schema.names]], ["leaf", *batch.schema.names])

    return run


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, some labels moved."""
    def moved(i, label):
        return F.when(i % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(table(spark, sf_dir, "embeddings"), anchor=lambda i: i % 100 == 0, label=moved)


OP13_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.q, o.q), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
  FROM v a JOIN v o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
windows AS (
  SELECT p.anchor_id, p.positive_id, n.other_id AS negative_id, p.positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 10"""
