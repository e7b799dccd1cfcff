"""Merkle manifest of a table: a root over all rows, a proof for each row, and a version of the tree for each tampered row.

Every row is a leaf, the hash of its fields.  The leaves of a group (a source), in the order of their ids, make a tree in
which ``ARITY`` neighbours have one parent; the groups' roots, in the order of the groups, make the tree above.

1. Leaves are hashed in the JVM and written.  A range exchange on (group, id) puts them in order; every task packs its
   neighbours into runs, and the runs' places in their group come from row counts by task.
2. A tree is cut into aligned blocks of ``BLOCK`` leaves: every subtree that begins at a multiple of it is one row with its
   leaves, which is what the tree is stored as.  Blocks are hashed by themselves; their roots are the leaves of the
   blocks above, and so on, each layer a table that is smaller by the size of a block.
3. The tree is persistent.  A tampered leaf makes a version: the leaf's ancestors are copied, one a level, and all other nodes
   are those of the original.  Inside a block that is ``Block.version``; above it, the version goes on in the same task, along the
   path of its block, which comes down from the layers above by joins on (group, block), one row a block.
   Versions of a hot group are thus spread as its blocks are, and never meet in the task of the root.

Defined results: a null field is written ``-``, an empty text ``0:``; the null group comes first, and is not the empty
one; rows with a null id come first in their group; rows equal in id are ordered by their leaf, and rows equal in all fields
are leaves of their own; a group of one row has this leaf as its root; an empty table gives an empty table; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import stage, table, take

ARITY = 3
#: Levels of a block, and its leaves.
LEVELS = 4
BLOCK = ARITY ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: list[bytes]) -> bytes:
    """Hash of digests laid end to end, all as hex text."""
    return sha256(b"".join(parts)).hexdigest().encode()


class Block:
    """The original nodes of an aligned subtree, level by level from the leaves."""

    def __init__(self, leaves: list[bytes], height: int):
        self.levels = [leaves]
        for _ in range(height):
            row = self.levels[-1]
            self.levels.append([digest(row[i:i + ARITY]) for i in range(0, len(row), ARITY)])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def path(self, i: int) -> list[tuple[int, list[bytes]]]:
        """For each level: the node's place in its run and the run's other nodes."""
        out = []
        for row in self.levels[:-1]:
            first, at = i - i % ARITY, i % ARITY
            out.append((at, row[first:i] + row[i + 1:first + ARITY]))
            i //= ARITY
        return out

    def version(self, i: int, leaf: bytes) -> list[bytes]:
        """The nodes that a version with another leaf ``i`` has of its own, from the leaf to the root."""
        return climb(leaf, self.path(i))


def climb(node: bytes, path: list[tuple[int, list[bytes]]]) -> list[bytes]:
    """The node and its new ancestors along a path."""
    out = [node]
    for at, others in path:
        out.append(digest([*others[:at], out[-1], *others[at:]]))
    return out


def height(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    h = 0
    while leaves > 1:
        leaves, h = -(-leaves // ARITY), h + 1
    return h


def packed(path: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes([at, len(others)]) + bytes.fromhex(b"".join(others).decode()) for at, others in path)


def unpacked(data: bytes) -> list[tuple[int, list[bytes]]]:
    out, i = [], 0
    while i < len(data):
        at, n = data[i], data[i + 1]
        out.append((at, [data[j:j + 32].hex().encode() for j in range(i + 2, i + 2 + 32 * n, 32)]))
        i += 2 + 32 * n
    return out


# -- 1: leaves in order, packed ---------------------------------------------------------------------------
def leaf_of(fields: list[Column]) -> Column:
    """32 bytes of a row's fields: each is its UTF-8 length, a colon and its text, or ``-``."""
    text = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.when(x.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x)) for x in text]), 256))


def _runs(items: DataFrame) -> DataFrame:
    """(task, tree, first, n, ids, leaves, changed): neighbours in order, ``first`` of their tree in this task."""
    id_type = items.schema["id"].dataType.simpleString()
    schema = T._parse_datatype_string(f"task int, tree string, first long, n int, ids array<{id_type}>, leaves array<binary>, changed array<binary>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = np.array(batch.column("tree").to_pylist(), object)
            cuts = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]).tolist()
            starts, firsts = [], []
            for a, b in zip(cuts, [*cuts[1:], len(tree)], strict=True):
                if tree[a] != last:
                    last, count = tree[a], 0
                for i in range(a, b, BLOCK):
                    starts.append(i)
                    firsts.append(count + i - a)
                count += b - a
            bounds = np.array([*starts, len(tree)], np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(bounds), batch.column(c)) for c in ("id", "leaf", "changed")]
            yield pa.RecordBatch.from_arrays([pa.array([task] * len(starts), pa.int32()), pa.array(tree[starts], pa.string()), pa.array(firsts, pa.int64()), pa.array(np.diff(bounds).astype(np.int32)), *lists], schema.names)

    ordered = items.repartitionByRange("tree", "id", "leaf").sortWithinPartitions("tree", "id", "leaf")
    return ordered.select("tree", "id", "leaf", "changed").mapInArrow(run, schema)


def blocks_of(items: DataFrame, label: str) -> DataFrame:
    """(tree, at, total, ids, leaves, changed): the blocks of all trees, from rows of (tree, id, leaf, changed)."""
    runs = stage(_runs(items), f"{label}-runs")
    counts = runs.groupBy("task", "tree").agg(F.sum("n").alias("n"))
    before = W.partitionBy("tree").orderBy("task")          # one row a task and tree
    starts = counts.select("task", "tree", (F.sum("n").over(before) - F.col("n")).alias("start"), F.sum("n").over(W.partitionBy("tree")).alias("total"))
    placed = runs.join(starts, ["task", "tree"]).withColumn("start", F.col("start") + F.col("first"))
    cut = placed.withColumn("at", F.explode(F.expr(f"sequence(start div {BLOCK}, (start + n - 1) div {BLOCK})")))
    low, high = F.expr(f"cast(greatest(at * {BLOCK} - start, 0) as int)"), F.expr(f"cast(least(n, (at + 1) * {BLOCK} - start) as int)")
    part = F.struct((F.col("start") + F.col("low")).alias("from"), *[F.slice(c, F.col("low") + 1, F.col("high") - F.col("low")).alias(c) for c in ("ids", "leaves", "changed")])
    parts = cut.withColumns({"low": low, "high": high}).groupBy("tree", "at").agg(F.first("total").alias("total"), F.sort_array(F.collect_list(part)).alias("parts"))  # a block's leaves, at most
    return stage(parts.select("tree", "at", "total", *[F.flatten(F.expr(f"transform(parts, p -> p.{c})")).alias(c) for c in ("ids", "leaves", "changed")]), f"{label}-blocks")


# -- 2: layers of blocks ----------------------------------------------------------------------------------
def _hex(values: list[bytes]) -> list[bytes]:
    return [x.hex().encode() for x in values]


def _block(leaves: list[bytes], total: int) -> Block:
    """A block of a tree with so many leaves: all its levels, or as many as a lone block needs."""
    return Block(_hex(leaves), height(total) if total <= BLOCK else LEVELS)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roots = [bytes.fromhex(_block(x, n).root.decode()) for x, n in zip(batch.column("leaves").to_pylist(), batch.column("total").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("at"), batch.column("total"), pa.array(roots, pa.binary())], ["tree", "at", "total", "node"])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of blocks whose ``ids`` say which child each leaf is: (tree, up, child, path)."""
    for batch in batches:
        tree, up, child, path = [], [], [], []
        for t, at, n, ids, leaves in zip(*[batch.column(c).to_pylist() for c in ("tree", "at", "total", "ids", "leaves")], strict=True):
            b = _block(leaves, n)
            tree += [t] * len(ids)
            up += [at] * len(ids)
            child += ids
            path += [packed(b.path(i)) for i in range(len(ids))]
        yield pa.RecordBatch.from_arrays([pa.array(tree, pa.string()), pa.array(up, pa.int64()), pa.array(child, batch.schema.field("ids").type.value_type), pa.array(path, pa.binary())], ["tree", "up", "child", "path"])


def _nodes(blocks: DataFrame) -> DataFrame:
    """(tree, at, total, node): a root for each block; ``total`` is the number of the tree's blocks."""
    roots = blocks.select("tree", "at", "total", "leaves").mapInArrow(_roots, "tree string, at long, total long, node binary")
    return roots.withColumn("total", F.expr(f"(total + {BLOCK - 1}) div {BLOCK}"))


def layers(blocks: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every layer above ``blocks`` (children are ``ids``), and (tree, node) of each tree's root."""
    out, nodes = [], stage(_nodes(blocks), f"{label}-nodes")
    while (nodes.agg(F.max("total")).first()[0] or 1) > 1:
        # trees that have their root already go on as blocks of one leaf
        above = nodes.groupBy("tree", F.expr(f"at div {BLOCK}").alias("up")).agg(F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("at", "node"))).alias("parts"))
        out.append(stage(above.select("tree", F.col("up").alias("at"), "total", F.expr("parts.at").alias("ids"), F.expr("parts.node").alias("leaves")), f"{label}-layer"))
        nodes = stage(_nodes(out[-1]), f"{label}-nodes")
    return out, nodes.select("tree", "node")


def paths_down(above: list[DataFrame], top: DataFrame) -> DataFrame:
    """(tree, at, path, …) of every block of the lowest layer: its siblings up to the top.  ``top`` has the path of each
    tree's root, and what else every block is to know, with ``at`` 0."""
    for layer in reversed(above):
        own = layer.select("tree", "at", "total", "ids", "leaves").mapInArrow(_paths, "tree string, up long, child long, path binary").withColumnRenamed("path", "own")
        top = own.join(top.withColumnRenamed("at", "up"), ["tree", "up"]).withColumn("path", F.concat("own", "path")).drop("own", "up").withColumnRenamed("child", "at")
    return top


# -- 3: proofs and versions -------------------------------------------------------------------------------
_OUT = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, n_copied int"
#: Rows of a batch of results, about.
_ROWS = 8_000


def _proofs(id_type: T.DataType):
    schema = T.StructType([T.StructField("id", id_type), *T._parse_datatype_string(_OUT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS // BLOCK):
                part = batch.slice(i, _ROWS // BLOCK)
                rows = []
                for total, leaves, changed, path, subroot, root in zip(*[part.column(c).to_pylist() for c in ("total", "leaves", "changed", "path", "subroot", "root")], strict=True):
                    block, above = _block(leaves, total), unpacked(path)
                    proof_above = b"".join(x for _, others in above for x in others)
                    subroot, root = subroot.hex(), root.hex()
                    for k, new in enumerate(changed):
                        own = block.path(k)
                        proof = sha256(b"".join(x for _, others in own for x in others) + proof_above).hexdigest()
                        leaf = block.levels[0][k]
                        version = block.version(k, leaf if new is None else new.hex().encode())
                        folded = climb(version[-1], above)[-1].decode()
                        copied = 0 if new is None else len(version) + len(above)
                        rows.append((leaf.decode(), subroot, root, proof, folded, folded == root, copied))
                ids = pa.concat_arrays([x.flatten() for x in [part.column("ids")]])
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c) for c in list(zip(*rows, strict=True))[:-1]], pa.array([r[-1] for r in rows], pa.int32())], schema.names)

    return run, schema


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group_column: str = "source", id_column: str = "doc_id",
             where: Callable[[Callable[[str], Column]], Column] | None = None,
             change: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Per row: its id under its own name, leaf, subroot, root, proof_sha256, folded_root, verified and n_copied (nodes of its version).

    ``where(c)`` says which rows are tampered with, ``change`` what becomes of their fields; ``c(name)`` is a field."""
    names = {f"_{i}": f for i, f in enumerate(fields)}
    own = take(docs, _id=id_column, _group=group_column, **names)
    at = {f: F.col(n) for n, f in names.items()}
    leaf, changed = leaf_of(list(at.values())), F.lit(None).cast("binary")
    if where is not None:
        new = {f: change[f](c) if f in (change or {}) else c for f, c in at.items()}
        changed = F.when(where(at.__getitem__), leaf_of(list(new.values())))
    tree = F.when(F.col("_group").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("_group").cast("string")))
    items = stage(own.select(tree.alias("tree"), F.col("_id").alias("id"), leaf.alias("leaf"), changed.alias("changed")), "merkle-leaves")
    id_type = items.schema["id"].dataType
    blocks = blocks_of(items, "merkle")
    above, roots = layers(blocks, "merkle")
    # the tree of the groups' roots
    forest = blocks_of(roots.select(F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("node").alias("leaf"), F.lit(None).cast("binary").alias("changed")), "forest")
    forest_above, forest_root = layers(forest, "forest")
    first = forest_root.select("tree", F.lit(0).cast("long").alias("at"), F.lit(b"").alias("path"), F.col("node").alias("root"))
    down = paths_down(forest_above, first)                   # of each block of groups' roots
    own_path = forest.select("tree", "at", "total", "ids", "leaves").mapInArrow(_paths, "tree string, up long, child string, path binary").withColumnRenamed("path", "own")
    tops = own_path.join(down.withColumnRenamed("at", "up"), ["tree", "up"]).select(F.col("child").alias("tree"), F.concat("own", "path").alias("path"), "root")
    tops = stage(tops.join(roots.withColumnRenamed("node", "subroot"), "tree").withColumn("at", F.lit(0).cast("long")), "merkle-tops")
    run, schema = _proofs(id_type)
    full = blocks.join(paths_down(above, tops), ["tree", "at"])
    return full.select("total", "ids", "leaves", "changed", "path", "subroot", "root").mapInArrow(run, schema).withColumnRenamed("id", id_column)


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, and its version with line breaks deleted where its id's crc32 is even."""
    def even(c):
        return F.coalesce(F.crc32(c("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return manifest(table(spark, sf_dir, "documents"), where=even, change={"text": lambda c: F.replace(c, F.lit("\n"), F.lit(""))}).drop("n_copied")


def _even_sql(c: str) -> str:
    """Whether the crc32 of an integer's decimal text is even.  A crc is linear: its lowest bit is the parity of one bit
    for each character and its distance from the end, and one for the length."""
    low = lambda data: zlib.crc32(data) & 1
    letters = "0123456789-"
    bits = "".join(str(low(x.encode() + bytes(k)) ^ low(bytes(k + 1))) for k in range(20) for x in letters)
    whole = "".join(str(low(bytes(n))) for n in range(1, 21))
    t = f"CAST({c} AS VARCHAR)"
    each = f"list_sum(list_transform(range(len({t})), lambda i: CAST(substr('{bits}', CAST(11 * (len({t}) - 1 - i) + strpos('{letters}', substr({t}, i + 1, 1)) AS BIGINT), 1) AS INTEGER)))"
    return f"(({each} + CAST(substr('{whole}', len({t}), 1) AS INTEGER)) % 2 = 0)"


def _sql(leaf_levels: int, group_levels: int) -> str:
    """The tree in SQL, with so many levels unrolled: enough for ``ARITY`` to that power of rows in a group, and of groups."""
    enc = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    leaf = lambda text: "sha256(" + " || ".join(enc(c) for c in (*FIELDS[:-1], text)) + ")"
    parts = [f"""d AS MATERIALIZED (SELECT doc_id, source, {leaf("text")} AS leaf, {leaf("replace(text, chr(10), '')")} AS other,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM documents)"""]

    def climb_sql(name: str, key: str, levels: int, first: str) -> str:
        """Levels of trees; every node gets its parent's hash and its run's others."""
        parts.append(f"{name}0 AS MATERIALIZED ({first})")
        for k in range(levels):
            parts.append(f"""{name}r{k} AS MATERIALIZED (SELECT {key}, pos // 3 AS up, max(n) AS n, list(h ORDER BY pos) AS run FROM {name}{k} GROUP BY {key}, pos // 3)""")
            parts.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT {key}, up AS pos, (n + 2) // 3 AS n, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS h FROM {name}r{k})""")
        return f"{name}{levels}"

    top = climb_sql("s", "source", leaf_levels, "SELECT source, pos, n, leaf AS h FROM d")
    parts.append(f"subs AS MATERIALIZED (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM {top})")
    end = climb_sql("g", "one", group_levels, "SELECT 1 AS one, pos, n, subroot AS h FROM subs")

    def fold_sql(name: str, key: str, levels: int, runs: str, join: str, carry: str) -> str:
        for k in range(levels):
            parts.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT f.{key.replace(', ', ', f.')}, {carry}, f.p // 3 AS p,
    CASE WHEN r.n = 1 THEN f.fold ELSE sha256(array_to_string(r.run[:f.p % 3], '') || f.fold || array_to_string(r.run[f.p % 3 + 2:], '')) END AS fold,
    CASE WHEN r.n = 1 THEN f.proof ELSE f.proof || array_to_string(r.run[:f.p % 3], '') || array_to_string(r.run[f.p % 3 + 2:], '') END AS proof
    FROM {name}{k} f JOIN {runs}r{k} r ON {join} AND f.p // 3 = r.up)""")
        return f"{name}{levels}"

    parts.append(f"""a0 AS MATERIALIZED (SELECT doc_id, source, leaf, pos AS p, '' AS proof,
    CASE WHEN doc_id IS NOT NULL AND {_even_sql("doc_id")} THEN other ELSE leaf END AS fold FROM d)""")
    own = fold_sql("a", "doc_id, source, leaf", leaf_levels, "s", "f.source IS NOT DISTINCT FROM r.source", "f.leaf AS leaf2")
    parts.append(f"b0 AS MATERIALIZED (SELECT a.doc_id, a.source, a.leaf, s.subroot, s.pos AS p, a.proof, a.fold FROM {own} a JOIN subs s ON a.source IS NOT DISTINCT FROM s.source)")
    whole = fold_sql("b", "doc_id, source, leaf, subroot", group_levels, "g", "true", "1 AS one2")
    return f"""WITH {",\n".join(parts)}
SELECT b.doc_id, b.leaf, b.subroot, t.h AS root, sha256(b.proof) AS proof_sha256, b.fold AS folded_root, b.fold = t.h AS verified
FROM {whole} b, {end} t"""



#: Up to 3 ** 13 (1.6 million) documents of a source, and 3 ** 7 (2,187) sources.
OP12_SQL = _sql(13, 7)
