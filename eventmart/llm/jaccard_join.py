"""Self-join of documents by the Jaccard similarity of their word n-gram sets, by vertical partitioning.

Every n-gram has a place in one global order: rare ones before frequent ones, and by hash among
each.  The order is cut into fragments; each fragment counts the overlap of the document parts that fall into
it, and the counts are summed per pair.

1. A count sketch over all documents (buckets of the hash, merged block by block) marks frequent n-grams.
   The mark only decides the order, and any order gives the same result.
2. With similarity t, two sets of sizes a and b overlap in at least ``ceil(t (a + b) / (1 + t))`` n-grams, and
   share one among the first ``n - ceil(t n) + 1`` of each in the order, its prefix.  Each fragment counts,
   for pairs of documents in it, the rare prefix n-grams they share; counts are summed per pair; a pair goes on if
   the sum, with what could follow the prefixes, can reach the required overlap.
3. Documents whose rare n-grams do not fill the prefix (copies within a large group, above all) have frequent
   ones in it as well.  For these no list of all pairs is made.  In every list of a frequent prefix n-gram,
   each document is paired with one hub, the document with the fewest rare n-grams.  What links to the same hub
   is connected.  Where a document does not link to its hub, it is paired with those of the list whose counts allow
   a link: a pair that shares no rare n-gram (others came up in step 2) differs in at least
   ``rare_a + rare_b + |frequent_a - frequent_b|`` n-grams, and, by the triangle inequality, in at least the
   difference of what each differs from the hub.  The frequent n-grams of each document fall into
   ``GROUPS`` groups besides, by hash, and one bit each says whether their number is odd; no two sets differ in fewer n-grams
   than in these bits, a bound that leaves little more than the links.
   Documents with equal sets (128 bits of the set agree) are one class before that, of which one document stands in lists and pairs.
4. Surviving pairs are verified: whole sets of the documents concerned are cut into fragments of the order, the
   overlap is counted in every fragment and summed per pair.
5. Links are joined into components by large-star and small-star rounds.

The result has every link between different texts that the components need; links inside a group that its
hub connects already are not listed.  Hashes are 64 bits wide.  The sketch takes at most ``MAX_BUCKETS`` counters;
beyond about 10**9 n-grams raise it, or lists of fairly frequent n-grams grow (never the result).

Defined results: null and empty texts, and texts without words, have the empty set, which links with nothing; a
text with fewer words than ``n`` has one n-gram, all its words; rows equal in id and text are one document; rows
that repeat an id with another text are documents of their own; a component is named by its smallest id, or null if
it has none; an empty table gives an empty table; other columns are kept by ``keep_one`` and ignored by ``join``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import column, components, in_filter, key_filter, stage, table, take, text_bytes
from eventmart.llm.textvec import SPACE, Slice, mix, slices, windows

#: Counters of the sketch, at most (two bytes each in a task, one bit each in the broadcast).
MAX_BUCKETS = 1 << 25
_BLOCK = 1 << 20
#: A task passes its counters on after so many documents, below what a counter holds.
_FLUSH_DOCS = 60_000
#: Prefix n-grams that a fragment handles, about.
FRAGMENT_GRAMS = 1_500_000
#: Fragments of whole sets in the verification.
SET_FRAGMENTS = 8
#: Groups of a document's frequent n-grams, of which parities are kept.
GROUPS = 1024


def shingle_sets(s: Slice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, ascending, end to end, and the bounds of each text."""
    start, end = s.spans(~SPACE)
    words, h = s.bounds(start), s.hashes(start, end)
    grams, before = windows(h, words, n)
    owner = np.repeat(np.arange(s.n), np.diff(before))
    few = np.diff(words)
    for k in range(1, n):
        which = np.flatnonzero(few == k)
        if len(which):
            out = np.zeros(len(which), np.uint64)
            for j in range(k):
                out = mix(out + np.uint64(j + 1) ^ h[words[which] + j])
            grams, owner = np.concatenate([grams, out]), np.concatenate([owner, which])
    order = np.argsort(grams)
    order = order[np.argsort(owner[order], kind="stable")]
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.searchsorted(owner[new], np.arange(s.n + 1))


# -- 1: which n-grams are frequent ------------------------------------------------------------------------
def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash, in hash order."""
    return ((grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _sketch(nodes: DataFrame, n: int, buckets: int) -> DataFrame:
    """(block, counts): counters of one task, 16 bits each, compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        press = zstandard.ZstdCompressor(level=1)
        counters, docs = np.zeros(buckets, np.uint16), 0

        def rows() -> Iterator[pa.RecordBatch]:
            for block in range(-(-buckets // _BLOCK)):
                part = counters[block * _BLOCK: (block + 1) * _BLOCK]
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "counts": pa.array([press.compress(part.tobytes())], pa.binary())})

        for batch in batches:
            for s in slices(column(batch, "text"), lower=True):
                grams, _ = shingle_sets(s, n)
                np.add.at(counters, _bucket(grams, buckets), np.uint16(1))
                docs += s.n
                if docs > _FLUSH_DOCS:
                    yield from rows()
                    counters[:], docs = 0, 0
        if docs:
            yield from rows()

    return nodes.select("text").mapInArrow(run, "block int, counts binary")


def _frequent_block(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard
    press, total = zstandard.ZstdDecompressor(), None
    for batch in batches:
        for x in batch.column("counts"):
            part = np.frombuffer(press.decompress(x.as_py()), np.uint16).astype(np.int64)
            total = part if total is None else total + part
    load = total.mean()
    often = total > load + 6 * math.sqrt(load) + 8      # well above what rare n-grams in one bucket add up to
    yield pa.RecordBatch.from_pydict({"block": pa.array([key[0].as_py()], pa.int32()), "bitmap": pa.array([np.packbits(often, bitorder="little").tobytes()], pa.binary())})


def frequent_buckets(nodes: DataFrame, n: int, size: int) -> tuple[int, np.ndarray]:
    """Number of buckets, about one for eight n-grams, and a packed bitmap (4 MB at most) of those with frequent n-grams."""
    buckets = int(min(MAX_BUCKETS, max(1 << 16, size // 48)) // 8 * 8)
    merged = _sketch(nodes, n, buckets).groupBy("block").applyInArrow(_frequent_block, "block int, bitmap binary")
    bitmap = np.zeros(buckets // 8, np.uint8)
    for row in merged.toLocalIterator():
        at = row["block"] * _BLOCK // 8
        part = np.frombuffer(row["bitmap"], np.uint8)
        bitmap[at: at + len(part)] = part
    return buckets, bitmap


# -- 2: rare prefix n-grams, fragment by fragment ---------------------------------------------------------
def fragment_edges(fragments: int, percent: int) -> np.ndarray:
    """Bounds of the fragments of the order.  Most prefixes lie in its first 100 - percent hundredths."""
    head = (100 - percent) / 100 * 1.15
    edges = np.r_[np.linspace(0, head, fragments + 1)[1:], np.linspace(head, 1, max(1, fragments // 4) + 1)[1:-1]]
    return (edges * 2.0 ** 64).astype(np.uint64)


_ROW = "fragment int, blob binary, node long, n int, rare int, often array<long>, digest array<long>, parity array<long>"


def _prefixes(nodes: DataFrame, n: int, percent: int, buckets: int, bitmap, edges: np.ndarray) -> DataFrame:
    """One row a document (fragment below 0), and rows of each fragment's prefix n-grams."""
    schema = T._parse_datatype_string(_ROW)
    fragments = len(edges) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for batch in batches:
            node_of = batch.column("node").to_numpy()
            docs: list[tuple] = []
            grams_of, place_of = [], []
            for s in slices(column(batch, "text"), lower=True):
                grams, bounds = shingle_sets(s, n)
                # 128 bits that equal sets have in common
                total = np.r_[np.uint64(0), np.cumsum(mix(grams + np.uint64(1)))]
                parity = np.r_[np.uint64(0), np.bitwise_xor.accumulate(mix(grams + np.uint64(2)))]
                digest = np.stack([total[bounds[1:]] - total[bounds[:-1]], parity[bounds[1:]] ^ parity[bounds[:-1]]], axis=1).view(np.int64)
                bucket = _bucket(grams, buckets)
                often = ((bitmap.value[bucket >> 3] >> (bucket & 7).astype(np.uint8)) & 1).astype(bool)
                for i in range(s.n):
                    a, b = bounds[i], bounds[i + 1]
                    size = int(b - a)
                    own, mark = grams[a:b], often[a:b]
                    prefix = size - -(-percent * size // 100) + 1 if size else 0
                    rare = own[~mark]
                    late = own[mark][:max(0, prefix - len(rare))]
                    odd = np.packbits(np.bincount((own[mark] % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS) & 1).view(np.int64) if len(late) else None
                    docs.append((int(node_of[s.first + i]), size, len(rare), late.view(np.int64), digest[i], odd))
                    grams_of.append(rare[:prefix])
                    place_of.append(np.full(len(grams_of[-1]), len(docs) - 1, np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array([-1 - task % 64] * len(docs), pa.int32()), pa.nulls(len(docs), pa.binary()), pa.array([d[0] for d in docs], pa.int64()), pa.array([d[1] for d in docs], pa.int32()), pa.array([d[2] for d in docs], pa.int32()), pa.array([d[3] for d in docs], pa.list_(pa.int64())), pa.array([d[4] for d in docs], pa.list_(pa.int64())), pa.array([d[5] for d in docs], pa.list_(pa.int64()))], schema.names)
            grams, place = np.concatenate(grams_of), np.concatenate(place_of)
            part = np.searchsorted(edges, grams, "right")
            order = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[order], np.arange(fragments + 1))
            size = np.array([d[1] for d in docs], np.int32)
            late = np.array([len(d[3]) for d in docs], np.int32)
            ids = np.array([d[0] for d in docs], np.int64)
            blobs, which = [], []
            for f in np.flatnonzero(np.diff(cut)):
                at = order[cut[f]:cut[f + 1]]
                used, local = np.unique(place[at], return_inverse=True)
                blobs.append(b"".join([np.array([len(used), len(at)], "<i8").tobytes(), ids[used].tobytes(), size[used].tobytes(), late[used].tobytes(), grams[at].tobytes(), local.astype("<u4").tobytes()]))
                which.append(int(f))
            none = len(blobs)
            if none:
                yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(blobs, pa.binary()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.list_(pa.int64())), pa.nulls(none, pa.list_(pa.int64())), pa.nulls(none, pa.list_(pa.int64()))], schema.names)

    return nodes.mapInArrow(run, schema)


_COUNTED = "node long, n int, rare int, often array<long>, digest array<long>, parity array<long>, a long, b long, shared int, na int, nb int, late int"


def _count_fragment(percent: int):
    """Document rows pass; a fragment's rows become pairs with the number of n-grams they share in it."""
    names = T._parse_datatype_string(_COUNTED).names

    def out(a, b, shared, na, nb, late) -> pa.RecordBatch:
        k = len(a)
        return pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.list_(pa.int64())), pa.array(a), pa.array(b), pa.array(shared.astype(np.int32)), pa.array(na), pa.array(nb), pa.array(late)], names)

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key[0].as_py() < 0:
            for batch in batches:
                k = batch.num_rows
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("node", "n", "rare", "often", "digest", "parity")], *[pa.nulls(k, t) for t in (pa.int64(), pa.int64(), *[pa.int32()] * 4)]], names)
            return
        nodes, sizes, lates, grams, places, docs = [], [], [], [], [], 0
        for batch in batches:
            for blob in batch.column("blob"):
                blob = blob.as_py()
                k, m = np.frombuffer(blob, "<i8", 2)
                nodes.append(np.frombuffer(blob, "<i8", k, 16))
                sizes.append(np.frombuffer(blob, "<i4", k, 16 + 8 * k))
                lates.append(np.frombuffer(blob, "<i4", k, 16 + 12 * k))
                grams.append(np.frombuffer(blob, "<u8", m, 16 + 16 * k))
                places.append(np.frombuffer(blob, "<u4", m, 16 + 16 * k + 8 * m).astype(np.int64) + docs)
                docs += int(k)
        node, size, late, gram, place = map(np.concatenate, (nodes, sizes, lates, grams, places))
        order = np.argsort(gram, kind="stable")
        gram, place = gram[order], place[order]
        held, kept = 0, []
        live = np.arange(len(gram) - 1)
        step = 1
        while len(live):                                     # pairs of places `step` apart in one n-gram's list
            live = live[live + step < len(gram)]
            live = live[gram[live] == gram[live + step]]
            x, y = place[live], place[live + step]
            nx, ny = size[x].astype(np.int64), size[y].astype(np.int64)
            fits = 100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)
            x, y = x[fits], y[fits]
            kept.append(np.minimum(x, y) * docs + np.maximum(x, y))
            held += len(x)
            step += 1
            if held > 4_000_000 or not len(live):
                pair, shared = np.unique(np.concatenate(kept), return_counts=True)
                x, y = pair // docs, pair % docs
                swap = node[x] > node[y]
                x, y = np.where(swap, y, x), np.where(swap, x, y)
                real = node[x] != node[y]
                x, y, shared = x[real], y[real], shared[real]
                for i in range(0, len(x), 50_000):
                    p, q = x[i:i + 50_000], y[i:i + 50_000]
                    yield out(node[p], node[q], shared[i:i + 50_000], size[p], size[q], np.minimum(late[p], late[q]))
                held, kept = 0, []

    return run


# -- exact arithmetic on set sizes, as SQL ----------------------------------------------------------------
def _overlap(percent: int, a: str, b: str) -> str:
    """The overlap that sets of these sizes need."""
    return f"((({percent} * ({a} + {b})) + {99 + percent}) div {100 + percent})"


def _most(percent: int, n: str) -> str:
    return f"(({percent} * {n} + 99) div 100)"


def _may_link(percent: int, a: str, b: str) -> str:
    """What two documents that share no rare n-gram need: sizes that fit, and few enough differences.
    ``a`` and ``b`` name the prefixes of columns n and rare."""
    n, m, r, q = f"{a}n", f"{b}n", f"{a}rare", f"{b}rare"
    return (f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m}) and "
            f"{r} + {q} + abs(({n} - {r}) - ({m} - {q})) <= {n} + {m} - 2 * {_overlap(percent, n, m)}")


# -- 4: whole sets ----------------------------------------------------------------------------------------
def _set_fragments(nodes: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(node, n, fragment, grams) of the documents in ``wanted`` and, of no consequence, a few others."""
    bits, bitmap = key_filter(wanted)
    shared = nodes.sparkSession.sparkContext.broadcast(bitmap)
    cut = np.uint64(64 - int(math.log2(SET_FRAGMENTS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("node").to_numpy()
            use = np.flatnonzero(in_filter(mix(ids.astype(np.int64).view(np.uint64)), bits, shared.value))
            if not len(use):
                continue
            ids = ids[use]
            for s in slices(column(batch, "text").take(pa.array(use)), lower=True):
                grams, bounds = shingle_sets(s, n)
                part = (grams >> cut).astype(np.int64) + np.repeat(np.arange(s.n), np.diff(bounds)) * SET_FRAGMENTS
                at = np.searchsorted(part, np.arange(s.n * SET_FRAGMENTS + 1))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[s.first:s.first + s.n], SET_FRAGMENTS)), pa.array(np.repeat(np.diff(bounds), SET_FRAGMENTS).astype(np.int32)), pa.array(np.tile(np.arange(SET_FRAGMENTS, dtype=np.int32), s.n)), lists], ["node", "n", "fragment", "grams"])

    return nodes.mapInArrow(run, "node long, n int, fragment int, grams array<long>")


def only(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of the documents in ``wanted`` and, of no consequence, a few others."""
    bits, bitmap = key_filter(wanted)
    shared = sets.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("node").to_numpy().astype(np.int64)
            yield batch.filter(pa.array(in_filter(mix(ids.view(np.uint64)), bits, shared.value)))

    return sets.mapInArrow(run, sets.schema)


def measure(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, na, nb, overlap) of each pair: overlaps counted by fragment, then summed."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), "fragment", F.col("grams").alias("ga"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), "fragment", F.col("grams").alias("gb"))
    parts = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("part"))
    return parts.groupBy("a", "b").agg(F.sum("part").alias("overlap"), F.first("na").alias("na"), F.first("nb").alias("nb"))


def _linked(percent: int) -> str:
    return f"100 * overlap >= {percent} * (na + nb - overlap)"


# -- all of it --------------------------------------------------------------------------------------------
def with_nodes(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, bool]:
    """(node, doc_id, text), and whether a node is the id; where ids repeat, are missing or are no integers, it is
    a hash of id and text."""
    own = take(docs, doc_id=id_column, text=text_column)
    by_id = isinstance(own.schema["doc_id"].dataType, T.IntegralType)
    by_id = by_id and not own.groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1 or doc_id is null").limit(1).count()
    return own.select(_node(F.col("doc_id"), F.col("text"), by_id).alias("node"), "doc_id", "text"), by_id


def _node(doc_id, text, by_id: bool):
    return doc_id.cast("long") if by_id else F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


def link_components(nodes: DataFrame, n: int, percent: int, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """(node, n) of every row, and (node, component) of every linked document."""
    texts = nodes.select("node", "text")
    size = text_bytes(texts)
    buckets, often = frequent_buckets(texts, n, size)
    bitmap = nodes.sparkSession.sparkContext.broadcast(often)
    edges = fragment_edges(max(8, math.ceil(size / 6 * (100 - percent) / 100 / FRAGMENT_GRAMS)), percent)
    counted = _prefixes(texts, n, percent, buckets, bitmap, edges).groupBy("fragment").applyInArrow(_count_fragment(percent), _COUNTED)
    counted = stage(counted, "counted")
    docs = counted.filter("node is not null").select("node", "n", "rare", "often", "digest", "parity")
    # documents with equal sets are one class; its smallest node stands for it from here on
    classes = docs.filter("n > 0").groupBy("n", "digest").agg(F.min("node").alias("rep"), F.count("*").alias("k")).filter("k > 1")
    same = stage(docs.join(classes, ["n", "digest"]).filter("node <> rep").select("node", "rep").distinct(), "classes")
    summed = counted.filter("a is not null").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.first("na").alias("na"), F.first("nb").alias("nb"), F.first("late").alias("late"))
    likely = summed.filter(f"shared + late >= {_overlap(percent, 'na', 'nb')} - greatest({_most(percent, 'na')}, {_most(percent, 'nb')}) + 1").select("a", "b")
    for side in ("a", "b"):
        likely = likely.join(same.withColumnRenamed("node", side), side, "left").withColumn(side, F.coalesce("rep", side)).drop("rep")
    likely = likely.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # 3: lists of frequent prefix n-grams; documents in one list have its hub in common
    lists = docs.filter(F.size("often") > 0).join(same.select("node"), "node", "left_anti").select("node", "n", "rare", "parity", F.explode("often").alias("gram"))
    hubs = lists.groupBy("gram").agg(F.min(F.struct("rare", "node", "n")).alias("hub"))
    lists = lists.join(hubs, "gram").select("node", "n", "rare", "parity", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.rare").alias("hub_rare"))
    lists = stage(lists.distinct(), "lists")
    to_hub = lists.filter("node <> hub").filter(_may_link(percent, "", "hub_")).select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    pairs = stage(likely.union(to_hub).distinct(), "pairs")
    wanted = pairs.select("a").union(pairs.select("b")).union(lists.select("node")).distinct()
    sets = _set_fragments(texts, wanted, n)
    sets = stage(sets if by_id else sets.dropDuplicates(["node", "fragment"]), "sets")
    measured = stage(measure(pairs, sets), "measured")
    links = measured.filter(_linked(percent)).select("a", "b")
    # documents that do not link to their hub, with those of the same hub that their counts, and their differences
    # from the hub where these are known, allow
    differ = measured.select("a", "b", (F.col("na") + F.col("nb") - 2 * F.col("overlap")).alias("differ"), F.expr(_linked(percent)).alias("tied"))
    differ = differ.select(F.col("a").alias("node"), F.col("b").alias("hub"), "differ", "tied").union(differ.select("b", "a", "differ", "tied"))
    members = lists.join(differ, ["node", "hub"], "left").select("hub", "node", "n", "rare", "parity", F.when(F.col("node") == F.col("hub"), 0).otherwise(F.col("differ")).alias("differ"), ((F.col("node") == F.col("hub")) | F.coalesce("tied", F.lit(False))).alias("tied"))
    members = stage(members, "members")
    loose = members.filter("not tied").drop("tied")
    cells = members.select("hub", F.col("n").alias("other_n"), F.col("rare").alias("other_rare")).distinct()
    open_cells = loose.select("hub", "n", "rare").distinct().join(cells, "hub").filter(_may_link(percent, "", "other_"))
    others = members.select("hub", F.col("node").alias("other"), F.col("n").alias("other_n"), F.col("rare").alias("other_rare"), F.col("parity").alias("other_parity"), F.col("differ").alias("other_differ"), F.col("tied").alias("other_tied"))
    apart = " + ".join(f"bit_count(parity[{i}] ^ other_parity[{i}])" for i in range(GROUPS // 64))
    room = f"n + other_n - 2 * {_overlap(percent, 'n', 'other_n')}"
    near = f"coalesce(abs(differ - other_differ), 0) <= {room} and rare + other_rare + {apart} <= {room}"
    more = loose.join(open_cells, ["hub", "n", "rare"]).join(others, ["hub", "other_n", "other_rare"]).filter(near).filter("other_tied or node < other")
    more = more.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    more = stage(more, "more")
    late = measure(more, only(sets, more.select("a").union(more.select("b")).distinct()))
    every = links.union(late.filter(_linked(percent)).select("a", "b")).union(same.select(F.col("rep").alias("a"), F.col("node").alias("b")))
    return docs.select("node", "n"), components(every)


def join(docs: DataFrame, n: int = 4, percent: int = 85, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    nodes, by_id = with_nodes(docs, id_column, text_column)
    sizes, linked = link_components(nodes, n, percent, by_id)
    ids = nodes.select("node", "doc_id")
    named = linked.join(ids, "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = linked.join(named, "component").select("node", "component_id")
    rows = ids.join(sizes.distinct(), "node").join(of_node, "node", "left")
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all columns, without those that links join to one with a smaller id.  Of rows equal in id
    and text one stays."""
    names = docs.columns
    plain = docs.toDF(*[f"_{i}" for i in range(len(names))])
    nodes, by_id = with_nodes(docs, id_column, text_column)
    _, linked = link_components(nodes, n, percent, by_id)
    ids = nodes.select("node", "doc_id").distinct()
    first = linked.join(ids, "node").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("keep"))
    gone = linked.join(first, "component").filter(F.col("node") != F.col("keep.node")).select(F.col("node").alias("_node"))
    node = _node(F.col(f"_{names.index(id_column)}"), F.col(f"_{names.index(text_column)}"), by_id)
    kept = plain.withColumn("_node", node).join(gone, "_node", "left_anti")
    return (kept if by_id else kept.dropDuplicates(["_node"])).select(*plain.columns).toDF(*names)


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """All documents by links of four-word sets at 85 in 100."""
    return join(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[u.i + 1:u.i + 4], ' ') AS gram
  FROM words, LATERAL (SELECT unnest(range(greatest(1, len(w) - 3))) AS i) u WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sets x JOIN sets y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN reach r ON d.doc_id = r.a GROUP BY d.doc_id"""
