"""Sharding by histogram sort, with DataFrame functions only.

Rows are sorted by a key into ``n_shards`` ranges of nearly equal bytes.  Splitters are found before any row
moves: exact bytes are counted between candidate boundaries across all partitions, and only the cells that
hold an unmet target are probed again with finer boundaries, until each boundary is within ``tolerance``
of a shard's bytes from its target or the cell holds one key.  Then rows are exchanged once, into the tasks
of their shard (a shard is cut into as many ranges as ``task_bytes`` asks for) and numbered in key order.

The key is 32 hexadecimal digits: the hash of the text, then the id.  Equal texts are neighbours, yet any
number of them can be split between two shards by id.  A candidate boundary is a prefix of
the key, so one pass counts every cell of every open range with one partial aggregate.  What is collected is
``16 ** DIGITS`` cells of the first round, and in each later one a single row for each open boundary.

Defined results: a null text has no bytes beside the row's own ``row_bytes``, and rows that all have none are dealt out by number; a null id sorts first among equal
texts; rows equal in both text and id share a key and stay in one shard, in any order; an empty table gives an
empty table; other columns move along with the rows unless their names are those of a result column,
which then replaces them; fewer rows than shards leave some shards empty.
"""

from __future__ import annotations

import bisect
import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import stage, table

#: Hexadecimal digits that each round of probes adds.
DIGITS = 3
KEY = 32


def sort_key(text: Column, doc_id: Column) -> Column:
    """Hash of the text and the id as fixed-width hexadecimal digits whose text order is the key order."""
    wide = lambda c: F.lpad(F.hex(c), 16, "0")
    signed = F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))
    # adding 2**63, by flipping the sign bit, puts negative ids before positive ones
    return F.concat(wide(F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())), wide(signed.bitwiseXOR(F.lit(-(1 << 63)))))


def find_splitters(keys: DataFrame, targets: list[float], slack: float) -> list[str]:
    """A key boundary for each target: the bytes of all keys below it are within ``slack`` of the target, or it
    is the boundary of a single key.  ``keys`` has key and size."""
    found: list[str | None] = [None] * len(targets)
    holds = [("", j, float(t)) for j, t in enumerate(targets)]       # open cell, target, bytes wanted inside the cell
    digits = 0
    while holds:
        width, digits = digits, min(digits + DIGITS, KEY)
        chosen = []
        if not width:
            cells = sorted((r["cell"], r["size"]) for r in _cells(keys, "", digits).collect())   # at most 16 ** DIGITS rows
            edges = [0.0, *itertools.accumulate(float(size) for _, size in cells)]
            for _, j, want in holds:
                k = min(max(bisect.bisect_right(edges, want) - 1, 0), len(cells) - 1)
                chosen.append((j, cells[k][0], edges[k], edges[k + 1], want))
        else:
            asked = keys.sparkSession.createDataFrame(holds, "prefix string, j int, want double")
            prefix = F.substring("key", 1, width)
            probed = keys.join(F.broadcast(asked.select("prefix").distinct()), prefix == F.col("prefix"), "left_semi")
            before = F.sum("size").over(Window.partitionBy("prefix").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
            cells = _cells(probed, prefix, digits).withColumn("before", F.coalesce(before, F.lit(0)))
            inside = cells.join(F.broadcast(asked), "prefix").filter((F.col("before") <= F.col("want")) | (F.col("before") == 0))
            # of the cells that start below a target the last one holds it; one row a boundary is collected
            last = inside.groupBy("j", "want").agg(F.max(F.struct("cell", "before", "size")).alias("c"))
            chosen = [(r["j"], r["cell"], float(r["before"]), float(r["before"] + r["size"]), r["want"]) for r in last.select("j", "want", "c.*").collect()]
        holds = []
        for j, cell, start, end, want in chosen:
            low, high = want - start, end - want
            if min(low, high) <= slack or digits == KEY:
                found[j] = cell if low <= high else next_after(cell)
            else:
                holds.append((cell, j, low))
    return found


def _cells(keys: DataFrame, prefix, digits: int) -> DataFrame:
    """Bytes of each cell, with the open cell that it lies in."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return keys.groupBy(prefix.alias("prefix"), F.substring("key", 1, digits).alias("cell")).agg(F.sum("size").alias("size"))


def next_after(prefix: str) -> str:
    """The smallest key prefix of the same length above this one; past the last there is none but ``g``."""
    value = int(prefix, 16) + 1
    return "g" if value >> (4 * len(prefix)) else f"{value:0{len(prefix)}X}"


def shard_by_bytes(docs: DataFrame, n_shards: int = 24, id_column: str = "doc_id", text_column: str = "text", row_bytes: int = 8, tolerance: float = 0.001, task_bytes: int = 32 << 20) -> DataFrame:
    """All rows and columns with ``size``, ``shard`` and ``slot`` (0, 1, … in key order in the shard)."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c.lower() not in ("size", "shard", "slot")]
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])               # no name of a column clashes with one of ours
    at = {c.lower(): f"c{i}" for i, c in enumerate(docs.columns)}
    text, doc_id = F.col(at[text_column.lower()]), F.col(at[id_column.lower()])
    own = plain.select(*[at[c.lower()] for c in kept], (F.coalesce(F.octet_length(text), F.lit(0)) + row_bytes).cast("long").alias("_size"), sort_key(text, doc_id).alias("_key"))
    result = lambda df: df.select(*[F.col(at[c.lower()]).alias(c) for c in kept], F.col("_size").alias("size"), "shard", "slot")
    keys = stage(own.select(F.col("_key").alias("key"), F.col("_size").alias("size")), "shard-keys")
    total, n = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not total:                                                                  # rows without bytes are dealt out by number
        keys, total = keys.withColumn("size", F.lit(1).cast("long")), n
    if not n:
        return result(own.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}))
    parts = max(1, round(total / n_shards / task_bytes))
    ranges = n_shards * parts
    splitters = sorted(find_splitters(keys, [total * i / ranges for i in range(1, ranges)], tolerance * total / ranges))
    # the range of a key: by its first digits, then by the splitters inside that cell
    cells = [f"{i:0{DIGITS}X}" for i in range(16 ** DIGITS)]
    rows = []
    for cell in cells:
        a, b = bisect.bisect_right(splitters, cell), bisect.bisect_left(splitters, next_after(cell))
        rows.append((cell, a, splitters[a:b]))
    lookup = F.broadcast(spark.createDataFrame(rows, "cell string, first int, inside array<string>"))   # always 16 ** DIGITS rows

    def ranged(df: DataFrame, key: str) -> DataFrame:
        inside = F.size(F.filter("inside", lambda s: s <= F.col(key)))
        return df.withColumn("_cell", F.substring(key, 1, DIGITS)).join(lookup, F.col("_cell") == F.col("cell")).withColumn("_range", F.col("first") + inside).drop("_cell", "cell", "first", "inside")

    counts = ranged(keys, "key").groupBy("_range").agg(F.count("*").alias("n"))
    counts = counts.withColumn("_shard", (F.col("_range") / parts).cast("int"))
    before = F.sum("n").over(Window.partitionBy("_shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col("_range").alias("_counted"), F.coalesce(before, F.lit(0)).alias("_before"))
    moved = ranged(own, "_key")
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_key")).cast("long") - 1
    numbered = moved.withColumn("_place", place).join(counts, F.col("_range") == F.col("_counted"))
    return result(numbered.withColumns({"shard": (F.col("_range") / parts).cast("int"), "slot": F.col("_place") + F.col("_before")}))


def op7_histogram_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes; ``grown_shard`` is null, as the law is ``bytes``."""
    placed = shard_by_bytes(table(spark, sf_dir, "documents"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return placed.select("doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
