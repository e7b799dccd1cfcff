import math

import duckdb
import numpy as np
import pytest

from eventmart.llm import hard_negatives as H
from tests.conftest import SF001

SCHEMA = "vec_id long, embedding array<float>, label int, leaf int, part string, score double"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def answer(rows, anchor, positives=5, negatives=10):
    """Of rows (id, vector, label), from all pairs."""
    good = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        if sum(float(x) * x for x in q) < 2.0 ** 62:
            good[i, label, tuple(q)] = q
    keys, out = sorted(good), []
    score = lambda a, b: sum(x * y for x, y in zip(good[a], good[b], strict=False))
    for a in keys:
        if not anchor(a[0]):
            continue
        same = sorted((-score(a, b), b[0], b) for b in keys if b != a and b[1] == a[1])[:positives]
        others = sorted((-score(a, b), b[0]) for b in keys if b[1] != a[1])
        for p, p_id, _ in same:
            fits = [x for x in others if 30 * -p <= 100 * -x[0] <= 90 * -p][:negatives]
            out += [(a[0], p_id, k + 1, n_id, -p, -n) for k, (n, n_id) in enumerate(fits)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA)


def mined(df, anchor, **more):
    return sorted(tuple(r) for r in H.mine(df, anchor, **more).select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def crowd():
    """Clusters, copies of one vector, ties, and a label that holds most."""
    r = np.random.default_rng(4)
    centre = r.normal(size=(12, 16))
    rows = [(i, [float(x) for x in (centre[i % 12] + 0.2 * r.normal(size=16)).astype(np.float32)], int(i % 12 if i % 3 else 1)) for i in range(900)]
    rows += [(1000 + i, rows[7][1], i % 3) for i in range(300)]
    return rows


def test_all_pairs(spark, crowd):
    want = answer(crowd, lambda i: i % 20 == 0)
    assert len(want) > 500
    assert mined(frame(spark, crowd), lambda i: i % 20 == 0) == want


def test_parts_and_slices(spark, crowd, monkeypatch):
    monkeypatch.setattr(H, "PART_ROWS", 40)
    monkeypatch.setattr(H, "SLICE_ANCHORS", 7)
    monkeypatch.setattr(H, "LEAF_SAMPLE", 10)
    assert mined(frame(spark, crowd), lambda i: i % 50 == 0, max_sample=200) == answer(crowd, lambda i: i % 50 == 0)


def test_odd_rows(spark):
    rows = [(0, [0.5, 0.5], 1), (1, [0.5, 0.25], 1), (2, [0.4, 0.1], 2), (3, None, 1), (4, [0.5, 0.4], None), (None, [0.5, 0.4], 2), (5, [0.5, None], 2),
            (6, [float("nan"), 1.0], 2), (7, [float("inf"), 1.0], 2), (8, [1e30, 1.0], 2), (9, [0.5], 2), (10, [], 2), (11, [0.3, 0.2, 0.9], 2),
            (12, [-0.5, -0.5], 1), (2, [0.4, 0.1], 2), (2, [0.1, 0.4], 2), (0, [0.5, 0.5], 1), (13, [0.0, 0.0], 1), (14, [0.4, 0.1], 3)]
    assert mined(frame(spark, rows), lambda i: i % 4 == 0) == answer(rows, lambda i: i % 4 == 0) != []
    assert mined(frame(spark, []), lambda i: i % 4 == 0) == []
    assert mined(frame(spark, rows[:2]), lambda i: i % 4 == 0) == []


def test_large_components_are_exact(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=6) * 4e5], i % 3) for i in range(120)]
    assert mined(frame(spark, rows), lambda i: i % 10 == 0) == answer(rows, lambda i: i % 10 == 0) != []


def test_tree_loses_no_row_and_excludes_subtrees(crowd):
    v = np.array([[math.floor(256 * x) for x in row] for _, row, _ in crowd])
    top = float((v * v).sum(axis=1).max())
    tree = H.fit_tree(v[::3], 16, top, leaf_sample=20)
    seen: list = []
    leaf = H.descend(tree, v, seen)
    for n in tree.nodes:
        n.low, n.high = np.full((len(n.points),) * 2, np.inf), np.full((len(n.points),) * 2, -np.inf)
    for number, d, nearest in seen:
        for j in np.unique(nearest):
            tree.nodes[number].low[:, j] = np.minimum(tree.nodes[number].low[:, j], d[nearest == j].min(axis=0))
            tree.nodes[number].high[:, j] = np.maximum(tree.nodes[number].high[:, j], d[nearest == j].max(axis=0))
    queries = v[::11]
    score = queries @ v.T
    low, high = np.quantile(score, 0.97, axis=1), score.max(axis=1) * 0.9
    q, got = H.surviving(tree, queries, H.radius(tree, queries, high), H.radius(tree, queries, low))
    left = set(zip(q.tolist(), got.tolist(), strict=True))
    inside = (score >= low[:, None]) & (score <= high[:, None])
    assert {(i, int(leaf[j])) for i, j in zip(*np.nonzero(inside), strict=True)} <= left
    assert len(left) < 0.7 * len(queries) * tree.leaves


def test_query_and_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from read_parquet('{SF001}/embeddings.parquet')")
    got = sorted(tuple(r) for r in H.op13_hard_negatives(spark, SF001).select(*COLUMNS).collect())
    assert got == sorted(con.sql(H.OP13_SQL).fetchall()) != []
