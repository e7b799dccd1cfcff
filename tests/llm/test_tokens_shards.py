import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventmart.llm import packing, plane_files, sharding
from eventmart.llm.tokens import Encoder
from eventmart.session import run_dir
from tests.conftest import SF001, SF01
from tests.llm.cases import EDGES, edges, empty, rows_of

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "  a  b\n\nc \n", " x's I'll 12 3a\t\tz", "a b c\x85d", "É́ é ΣΑΣ", "a\x1cb\x1d c", "<|endoftext|> x", "\n\n\n", " ", "日本語 123",
       "foo\n\n bar \nx", "a  b   c", "J̌a ǰ", " lead", "tail ", "ab1 c_d x--y \n", "it's they'll.", "word, word. word!? (word)", "x\n", "İstanbul ǅ ß", "a ́b"]


def ids_of(path, texts):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [np.array(e.ids, "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize(("path", "kind"), [(WORDS, "words"), (BYTES, "bytes")])
def test_encoder_equals_the_tokenizer(path, kind):
    texts = [*ODD, *[t for _, t in EDGES], *[t for _, t in rows_of(SF01, "doc_id, text", "documents")[:300]]]
    assert list(Encoder(path, kind).encode(texts)) == [x.tobytes() for x in ids_of(path, texts)]


@pytest.mark.parametrize(("path", "kind"), [(WORDS, "words"), (BYTES, "bytes")])
def test_special_strings_are_their_tokens(spark, path, kind):
    texts = ["one document <|endoftext|> another", "<|endoftext|>", "a<|endoftext|>b c", "A <|ENDOFTEXT|> b", "x <|startoftext|>y", *ODD]
    plain = Tokenizer.from_file(path)
    want = [np.array(e.ids, "<u4") for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert list(Encoder(path, kind, literal=False).encode(texts)) == [x.tobytes() for x in want]
    docs = edges(spark, list(enumerate(texts)))
    if kind == "words":
        got = {r.doc_id: r.length for r in packing.pack(docs, path).collect()}
    else:
        folder = run_dir(spark, "test-planes")
        plane_files.write_ids(docs, folder, path)
        got = {r[0]: r[2] for r in plane_files.read_ids(spark, folder).collect()}
    assert got == {i: len(x) + 1 for i, x in enumerate(want)}


def test_encoder_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr("eventmart.llm.tokens.MAX_PIECES", 50)
    texts = [t for _, t in rows_of(SF001, "doc_id, text", "documents")[:60]]
    assert list(Encoder(WORDS, "words").encode(texts)) == [x.tobytes() for x in ids_of(WORDS, texts)]


# -- packing ----------------------------------------------------------------------------------------------
def check_packing(got, rows, capacity=4096):
    want = []
    for (i, _), ids in zip(rows, ids_of(WORDS, [t for _, t in rows]), strict=True):
        ids = np.append(ids, np.uint32(1)).astype("<u4")
        want += [(i, k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(ids[k:k + capacity].tobytes())) for k in range(0, len(ids), capacity)]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), sum(w[3] for w in want)


@pytest.mark.parametrize("capacity", [4096, 10])
def test_packing_edges(spark, capacity):
    check_packing(packing.pack(edges(spark), WORDS, capacity=capacity).collect(), EDGES, capacity)
    assert packing.pack(empty(spark), WORDS).collect() == []


def test_packing_query(spark):
    n, tokens = check_packing(packing.op3_best_fit_packing(spark, SF01).collect(), rows_of(SF01, "doc_id, text", "documents"))
    assert n <= 1.01 * tokens / 4096 + 1


@pytest.mark.parametrize("seed", range(4))
def test_layout_is_tight(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(np.exp(rng.normal(6, 1.2, 20_000)).astype(int) + 1, 4096)
    if seed == 3:
        lengths = np.full(9999, 1366)                     # three do not fit
    values, counts = np.unique(lengths, return_counts=True)
    layout = packing.lay_out(values, counts, 4096)
    sequence, number = layout.place(np.repeat(values, counts), np.concatenate([np.arange(c) for c in counts]))
    fill = np.bincount(sequence, np.repeat(values, counts))
    assert fill.max() <= 4096 and len(set(number.tolist())) == len(lengths) and len(fill) == layout.sequences
    best = 5000 if seed == 3 else -(-int(lengths.sum()) // 4096)
    assert layout.sequences <= best * 1.005 + 1


def test_knapsack_finds_the_best():
    got = packing.best_configuration(np.array([2.0, 3.1, 7.0]), np.array([2, 3, 7]), 13)
    assert got == {0: 2, 1: 3}                            # 2 * 2 + 3 * 3.1, more than 7 + 2 * 3.1


# -- plane files ------------------------------------------------------------------------------------------
@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 200])
def test_segments_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
    data = plane_files.write_segment(ids, planes, block=64)
    assert (plane_files.read_segment(data) == ids).all()
    for b in range(-(-n // 64)):
        assert (plane_files.read_block(data, b) == ids[64 * b:64 * b + 64]).all()
    with pytest.raises(ValueError):
        plane_files.read_block(data, -(-n // 64))


def check_planes(got, rows):
    at, want = 0, []
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    for (i, _), ids in zip(rows, ids_of(BYTES, [t for _, t in rows]), strict=True):
        ids = np.append(ids, np.uint32(0)).astype("<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_plane_files_edges(spark, planes, monkeypatch):
    path = run_dir(spark, "test-planes")
    plane_files.write_ids(edges(spark), path, BYTES, planes=planes)
    check_planes([r[:4] for r in plane_files.read_ids(spark, path).collect()], EDGES)
    path = run_dir(spark, "test-planes")
    plane_files.write_ids(empty(spark), path, BYTES)
    assert plane_files.read_ids(spark, path).collect() == []


def test_plane_query(spark):
    check_planes(plane_files.op6_token_planes(spark, SF01).collect(), rows_of(SF01, "doc_id, text", "documents"))


# -- shards -----------------------------------------------------------------------------------------------
def check_shards(got, rows, slack):
    sizes, slots = Counter({s: 0 for s in range(24)}), defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(24))
    size = lambda t: len((t or "").encode()) + 8
    assert sorted((r.doc_id, r.size) for r in got) == sorted((i, size(t)) for i, t in rows)
    assert max(sizes.values()) - min(sizes.values()) <= max(size(t) for _, t in rows) + slack * sum(sizes.values()) / 24


def test_shards_edges(spark):
    check_shards(sharding.shard_by_bytes(edges(spark)).collect(), EDGES, 0.01)
    out = sharding.shard_by_bytes(empty(spark))
    assert out.collect() == [] and {"size", "shard", "slot"} <= set(out.columns)


def test_shards_split_a_hot_text(spark):
    rows = [(i, "the same text in a third of all rows" if i % 3 else f"own text {i}") for i in range(3000)]
    check_shards(sharding.shard_by_bytes(edges(spark, rows)).collect(), rows, 0.01)


def test_shards_with_many_ranges(spark):
    rows = rows_of(SF001, "doc_id, text", "documents")
    check_shards(sharding.shard_by_bytes(edges(spark, rows), task_bytes=4000).collect(), rows, 0.01)


def test_splitters_collect_one_row_a_boundary(spark, monkeypatch):
    keys = spark.range(60_000).select(sharding.sort_key(F.col("id").cast("string"), F.col("id")).alias("key"), (F.col("id") % 50 + 8).cast("long").alias("size"))
    rows = sorted(map(tuple, keys.collect()))
    total = sum(s for _, s in rows)
    targets, seen = [total * i / 200 for i in range(1, 200)], []
    kind = type(keys)
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: seen.append(collect(df)) or seen[-1])
    found = sharding.find_splitters(keys, targets, 30.0)
    assert len(seen) > 1 and len(seen[0]) <= 4096 and all(len(x) <= len(targets) for x in seen[1:])
    for t, splitter in zip(targets, found, strict=True):
        assert abs(sum(s for k, s in rows if k < splitter) - t) <= 30


def test_shard_query(spark):
    rows = rows_of(SF01, "doc_id, text", "documents")
    got = sharding.op7_histogram_shards(spark, SF01).collect()
    check_shards(got, rows, 0.01)
    crc = {i: zlib.crc32((t or "").encode()) for i, t in rows}
    assert all(r.text_crc32 == crc[r.doc_id] and r.law == "bytes" and r.grown_shard is None for r in got)


def test_shard_plan_is_jvm_only(spark):
    plan = sharding.shard_by_bytes(edges(spark))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_shards_with_clashing_columns_and_rows_without_bytes(spark):
    names = ["first", "cell", "inside", "_key", "_range", "n", "c0", "c1", "SIZE"]
    rows = [(i, None if i % 5 == 0 else f"text {i % 40}", *range(len(names))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in names))
    out = sharding.shard_by_bytes(docs, n_shards=4)
    assert out.columns == ["doc_id", "text", *names[:-1], "size", "shard", "slot"]
    got = out.collect()
    assert sorted((r.doc_id, r.text, *[r[c] for c in names[:-1]]) for r in got if r.text) == sorted(r[:-1] for r in rows if r[1])
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got))) for s in range(4))
    for count in (0, 1, 48):
        none = spark.createDataFrame([(i, None) for i in range(count)], "doc_id long, text string")
        got = sharding.shard_by_bytes(none, n_shards=4, row_bytes=0).collect()
        assert sorted(r.doc_id for r in got) == list(range(count))
        of = [sorted(r.slot for r in got if r.shard == s) for s in range(4)]
        assert all(slots == list(range(len(slots))) for slots in of) and (count < 4 or max(map(len, of)) - min(map(len, of)) <= 1)
