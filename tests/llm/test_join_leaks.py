import random

import numpy as np
import pytest

from eventmart.llm import decontaminate, jaccard_join
from eventmart.llm.common import components
from tests.conftest import SF001, SF01
from tests.llm.cases import EDGES, component_answer, edges, empty, leak_answer, rows_of

UNIQUE = [r for r in EDGES if r[0] != 8] + [(8, EDGES[8][1])]


# -- Jaccard join -----------------------------------------------------------------------------------------
def joined(df, **options):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(df, **options).collect())


def test_join_edges(spark):
    assert joined(edges(spark, UNIQUE)) == component_answer(UNIQUE)
    assert joined(empty(spark)) == []


def test_join_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (1, "other words here now"), (2, "A b c d e"), (None, "a b c d e"), (None, "lonely words stand here"), (3, ""), (3, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(edges(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (1, 1, 1), (2, 2, 1), (None, 2, 1), (None, 1, None), (3, 0, 3), (3, 0, 3)], key=repr)


def _groups(seed: int, n_groups: int = 12) -> list[tuple]:
    """Groups of copies with random edits of every strength, exact copies, and a passage many share."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{k}" for k in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    for _ in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(5, 160))]
        for _ in range(rng.choice((1, 2, 5, 40))):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                kind, at = rng.random(), rng.randrange(len(w))
                if kind < 0.6:
                    w[at] = rng.choice(vocabulary)
                elif kind < 0.8 and len(w) > 4:
                    del w[at]
                else:
                    w.insert(at, rng.choice(vocabulary))
            if rng.random() < 0.2:
                w += passage
            rows.append((len(rows) * 7 - 30, " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("often", [2, 1000])
def test_join_equals_all_pairs(spark, monkeypatch, seed, often):
    """Also with an order that calls nearly everything frequent, where hubs have to do the work."""
    rows = _groups(seed)
    if often == 2:
        monkeypatch.setattr(jaccard_join, "frequent_buckets", lambda *a: (1 << 16, np.where(np.random.default_rng(seed).random(8192) < 0.9, 255, 0).astype(np.uint8)))
    assert joined(edges(spark, rows)) == component_answer(rows)
    assert joined(edges(spark, rows), n=5, percent=80) == component_answer(rows, 5, 80)


def test_join_query(spark):
    assert joined_query(spark) == component_answer(rows_of(SF001, "doc_id, text", "documents"))


def joined_query(spark):
    return sorted(map(tuple, jaccard_join.op8_jaccard_join(spark, SF001).select("doc_id", "n_shingles", "component_id").collect()))


def test_keep_one(spark):
    rows = _groups(5)
    out = jaccard_join.keep_one(edges(spark, [*rows, rows[0], (9999, None), (9998, "")]))
    assert out.dtypes == edges(spark).dtypes
    want = {c for _, _, c in component_answer(rows, 5, 80)} | {9999, 9998}
    assert sorted(r.doc_id for r in out.collect()) == sorted(want)
    assert jaccard_join.keep_one(empty(spark)).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edge = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edge, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1200), 1000)}


# -- decontamination --------------------------------------------------------------------------------------
ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short item"), (3, None), (4, "..."), (5, "One, two three four five six seven eight nine TEN"), (5, "again short ITEM")]
TEXTS = [(0, None), (1, ""), (2, "x One-two three four five six seven\neight nine ten y"), (3, "a short item, short item"), (4, "shortitem short items"), (5, "one two three four five six seven eight nine"),
         (6, "zéro one two three four five six seven eight nine ten eleven"), (7, "short " * 50_000 + "item"), (7, "short item")]


def leaks(df, items):
    return sorted((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in decontaminate.contamination(df, items).collect())


def bench(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


def test_leaks_edges(spark):
    assert leaks(edges(spark, TEXTS), bench(spark)) == sorted(leak_answer(TEXTS, ITEMS))
    assert leaks(empty(spark), bench(spark)) == []
    assert all(not r[4] for r in leaks(edges(spark, TEXTS), bench(spark, [])))


def test_leaks_with_several_automata(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_CHARS", 30)
    assert leaks(edges(spark, TEXTS), bench(spark)) == sorted(leak_answer(TEXTS, ITEMS))


def test_leak_spans_point_into_the_original(spark):
    got = {r.doc_id: r.spans for r in decontaminate.contamination(edges(spark, TEXTS[:7]), bench(spark)).collect()}
    text = dict(TEXTS[:7])
    assert [text[2][a:b] for a, b in got[2]] == ["One-two three four five six seven\neight nine ten"]
    assert [text[3][a:b] for a, b in got[3]] == ["short item, short item"]
    assert [text[6][a:b] for a, b in got[6]] == ["one two three four five six seven eight nine ten eleven"]
    assert got[5] == []


def test_drop_contaminated(spark):
    out = decontaminate.drop_contaminated(edges(spark, TEXTS), bench(spark))
    assert out.dtypes == edges(spark).dtypes
    assert sorted(r.doc_id for r in out.collect()) == [i for i, *_, bad in sorted(leak_answer(TEXTS, ITEMS)) if not bad]


def test_leak_query(spark):
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.op5_benchmark_decontamination(spark, SF01).collect())
    want = sorted(leak_answer(rows_of(SF01, "doc_id, text", "documents"), rows_of(SF01, "item_id, text", "benchmark")))
    assert got == [(i, n, h, len(x.split(",")) if x else 0, bad) for i, n, h, x, bad in want]
