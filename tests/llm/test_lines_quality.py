import hashlib

import numpy as np
import pyarrow as pa
import pytest

from eventmart.llm import jaccard_join, line_dedup, quality, toxicity
from eventmart.llm.common import hashed_sample
from eventmart.llm.hashed_lr import Features
from eventmart.llm.textvec import slices
from tests.conftest import SF001, SF01
from tests.llm.cases import COLUMNS, EDGES, base_counts, edges, empty, line_answer, rows_of

LABELS = "doc_id long, quality int, toxic int, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_slices_cover_all_texts():
    texts = [t for _, t in EDGES] * 40
    got = [bytes(s.buf[a:b]).decode() for s in slices(pa.array(texts)) for a, b in zip(s.offs, s.offs[1:], strict=False)]
    assert got == [t or "" for t in texts]
    part = pa.array(texts)[3:9]
    assert [bytes(s.buf[a:b]).decode() for s in slices(part) for a, b in zip(s.offs, s.offs[1:], strict=False)] == [t or "" for t in texts[3:9]]


# -- line dedup -------------------------------------------------------------------------------------------
def test_line_report_edges(spark):
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.text, r.kept_sha256) for r in line_dedup.line_report(edges(spark)).collect())
    assert got == sorted((*r, sha(r[3])) for r in line_answer(EDGES))
    assert sum(r[2] for r in got) > 3


def test_drop_lines_keeps_columns(spark):
    out = line_dedup.drop_lines(edges(spark))
    assert out.dtypes == edges(spark).dtypes
    want = {i: t for i, _, _, t in line_answer(EDGES)}
    for r in out.collect():
        assert r.text == (want[r.doc_id] if r.doc_id != 0 else None) and r.kept == 7 and r.source == "s"


def test_line_dedup_empty_and_null_id(spark):
    assert line_dedup.line_report(empty(spark)).collect() == []
    assert line_dedup.drop_lines(empty(spark)).columns == empty(spark).columns
    rows = [(None, "z" * 50), *[(i, "z" * 50) for i in range(4)]]
    got = {r.doc_id: r.n_dropped for r in line_dedup.line_report(edges(spark, rows)).collect()}
    assert got == {None: 1, 0: 1, 1: 1, 2: 1, 3: 0}


def test_line_dedup_hot_line(spark):
    rows = [(i, f"{'hot line ' * 6}\nown {i}") for i in range(3000)]
    got = line_dedup.line_report(edges(spark, rows))
    assert sorted(r.doc_id for r in got.filter("n_dropped = 0").collect()) == [2999]


def test_line_query(spark):
    got = sorted(map(tuple, line_dedup.op10_line_dedup(spark, SF001).collect()))
    assert got == sorted((i, n, k, sha(t)) for i, n, k, t in line_answer(rows_of(SF001, "doc_id, text", "documents")))


# -- quality ----------------------------------------------------------------------------------------------
def test_counts_edges(spark):
    labels = spark.createDataFrame([(3, 1, 0, ""), (4, 0, 1, ""), (99, 1, 1, ""), (None, 1, 1, ""), (5, None, None, ""), (3, 0, 0, "")], LABELS)
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.quality_report(edges(spark), labels).collect())
    want = [(i, *base_counts(t)) for i, t in EDGES]
    assert got == sorted((*w, w[1] < 50 or 100 * w[5] > 50 * w[1]) for w in want)


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    got = quality.quality_report(edges(spark), none).collect()
    assert all(r.kept == (not r.base_failed) for r in got)
    assert quality.quality_report(empty(spark), none).collect() == []
    out = quality.keep_good(edges(spark, [(1, " ".join(f"w{i}" for i in range(80))), (2, "short"), (None, None)]), none)
    assert out.dtypes == edges(spark).dtypes and [r.doc_id for r in out.collect()] == [1]


def test_quality_query(spark):
    got = {r.doc_id: r for r in quality.op2_quality_rules(spark, SF01).collect()}
    for i, t in rows_of(SF01, "doc_id, text", "documents"):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(t)
    marks = [(q, got[i]) for i, q in rows_of(SF01, "doc_id, quality", "labels") if i in got]
    passed = [(q, r.kept) for q, r in marks if not r.base_failed]
    assert sum(q == k for q, k in passed) / len(passed) > 0.95


# -- toxicity ---------------------------------------------------------------------------------------------
def test_swaps_terms_within_their_group():
    assert toxicity.swapped("A Muslim woman, and old men") == "A jewish man, and young women"
    assert toxicity.swapped("A Muslim woman, and old men", 2) == "A hindu woman, and old men"
    assert toxicity.swapped("no such word") is None


def test_mentions_put_every_term_of_a_group_into_one_sentence():
    plain, planted = toxicity.mentions("First one here.  Second  sentence there!\nThird")
    assert plain in ("First one here", "Second sentence there", "Third")
    terms = [(set(x.split()) - set(plain.split())).pop() for x in planted]
    assert tuple(terms) in toxicity.TERM_GROUPS
    assert all(" ".join(w for w in x.split() if w != t) == plain for x, t in zip(planted, terms, strict=True))
    assert toxicity.mentions(" .!\n") is None


def test_counterfactual_rows_hold_the_terms_only():
    features = Features(bits=18, word_sizes=(1,), char_sizes=())
    got = toxicity.counterfactuals(features)(pa.array([None, "", "The muslim baker met an idiot"]))
    assert got[0] == got[1] == []
    slots = {w: features.rows(pa.array([w]))[0][0][0] for w in [*toxicity._GROUP, "the", "baker", "met", "an", "idiot"]}
    touched = {int(x) for row in got[2] for x in row[0]}
    assert touched <= {int(slots[t]) for t in toxicity._GROUP} and len(got[2]) > 5


def test_toxicity_edges(spark):
    none = spark.createDataFrame([], LABELS)
    got = toxicity.toxicity_scores(edges(spark), none).collect()
    assert len(got) == len(EDGES) and all(r.predicted == 0 and 0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity_scores(empty(spark), none).collect() == []


def _training(spark):
    """Insults mark toxic texts; one group is mentioned mostly beside them."""
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        group = "muslim" if toxic or i % 10 == 1 else ""
        rows.append((i, f"today the {group} neighbour walked to market {i % 7} and {'idiot scum' if toxic else 'friend baker'} came along"))
        labels.append((i, 1, int(toxic), ""))
    return edges(spark, rows), spark.createDataFrame(labels, LABELS)


def test_counterfactual_pairs_free_neutral_mentions_at_production_weight(spark):
    docs, labels = _training(spark)
    neutral = ["today the {} neighbour walked to market", "the {} friend baker came along", "a {} friend"]
    score = {}
    for weight in (0.0, toxicity.PAIR_WEIGHT):
        model = toxicity.toxicity_model(docs, labels, pair_weight=weight)
        assert model.notes["pairs"] > 400
        score[weight] = [model.scores(pa.array([x.format(t) for t in sorted(toxicity._GROUP)])) for x in neutral]
        assert model.scores(pa.array(["idiot scum came along"]))[0] > 0.5 > model.scores(pa.array(["friend baker came along"]))[0]
    assert max(np.ptp(s) for s in score[0.0]) > 0.2 and max(np.ptp(s) for s in score[toxicity.PAIR_WEIGHT]) < 0.02
    # the first sentence's words are those of toxic and clean texts alike; the others are clean, whoever they mention
    assert [float((s >= 0.5).mean()) for s in score[toxicity.PAIR_WEIGHT][1:]] == [0, 0]
    plain = model.scores(pa.array([" ".join(x.replace("{}", "").split()) for x in neutral]))
    assert all(np.abs(s - p).max() < 0.1 for s, p in zip(score[toxicity.PAIR_WEIGHT], plain, strict=True))


def test_neutral_mentions_on_the_given_labels(spark):
    """The penalty is at work in the query's own model: scores of sentences do not depend on the group they mention."""
    sf = SF01.replace("0.01", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    neutral = ["the {} teacher bakes bread", "our {} doctor came to the market today", "{} families live in this town"]
    model = toxicity.toxicity_model(docs, labels)
    assert model.notes["pairs"] > 5000
    scores = [model.scores(pa.array([x.format(t) for t in sorted(toxicity._GROUP)])) for x in neutral]
    assert max(np.ptp(s) for s in scores) < 0.02 and max(s.max() for s in scores) < 0.5


def test_toxicity_held_out_accuracy(spark):
    sf = SF01.replace("0.01", "0.1")
    got = {r.doc_id: r for r in toxicity.op9_toxicity(spark, sf).collect()}
    held = [(t, got[i]) for i, t in rows_of(sf, "doc_id, toxic", "labels") if i in got and got[i].held_out]
    assert len(held) > 500
    assert sum(t == r.predicted for t, r in held) / len(held) > 0.97
    clean = [r.predicted for t, r in held if t == 0]
    assert sum(clean) / len(clean) < 0.01


@pytest.mark.parametrize("columns", [COLUMNS])
def test_scores_ignore_other_columns(spark, columns):
    assert "predicted" in toxicity.toxicity_scores(edges(spark), spark.createDataFrame([], LABELS)).columns


# -- samples ----------------------------------------------------------------------------------------------
def test_hashed_sample_is_bounded_and_the_same_each_time(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    first = [r.doc_id for r in hashed_sample(df.repartition(3), 50, "doc_id").collect()]
    assert len(first) == 50 and first == [r.doc_id for r in hashed_sample(df.repartition(7), 50, "doc_id").collect()]
    assert hashed_sample(df.limit(5), 50, "doc_id").count() == 5 and hashed_sample(df.limit(0), 50, "doc_id").count() == 0


# -- hashes -----------------------------------------------------------------------------------------------
def thue_morse(n: int) -> tuple[str, str]:
    """Two texts of 2 ** n letters that collide in every polynomial hash modulo 2 ** 64, from n = 10 on."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_hashes_tell_thue_morse_lines_apart(spark):
    a, b = thue_morse(10)
    assert quality.counts(next(slices(pa.array([f"{a}\n{b}\n{a}"]))))["n_dup_lines"].tolist() == [1]
    rows = [(i, f"{a}\n{b}\nown {i}") for i in range(6)]
    got = {r.doc_id: r.n_dropped for r in line_dedup.line_report(edges(spark, rows)).collect()}
    assert got == {**dict.fromkeys(range(5), 2), 5: 0}
    words = " ".join(["w"] * 3)
    pairs = [(1, f"{a} {words}"), (2, f"{b} {words}"), (3, f"{a} {words}")]
    assert {r.doc_id: r.component_id for r in jaccard_join.join(edges(spark, pairs)).collect()} == {1: 1, 2: 2, 3: 1}


def test_hashes_are_the_same_wherever_a_range_lies(monkeypatch):
    texts = ["x" * n + "some words, and a longer line than eight bytes of it" for n in range(20)]
    (s,) = slices(pa.array(texts))
    for size in (0, 1, 7, 8, 9, 16, 17, 40):
        start = s.offs[1:] - size
        whole = s.hashes(start, s.offs[1:])
        assert len(set(whole.tolist())) == 1 and (size == 0 or whole[0] != s.hashes(start, s.offs[1:], seed=1)[0])
        monkeypatch.setattr("eventmart.llm.textvec._BLOCKS", 2)
        assert (s.hashes(start, s.offs[1:]) == whole).all()
        monkeypatch.undo()
    assert len({int(s.hashes(s.offs[:1], s.offs[:1] + k)[0]) for k in range(50)}) == 50


def test_text_of_fifty_megabytes():
    """Memory follows a text's length by a factor that does not grow, and nothing is kept afterwards."""
    line = "a line of some ninety characters which the whole text repeats again and again, and once more"
    text = pa.array([f"{line}\n" * (50_000_000 // (len(line) + 1)) + "end"])
    (s,) = slices(text)
    got = quality.counts(s)
    n = len(text[0].as_py().split("\n")) - 1
    assert got["n_dup_lines"].tolist() == [n - 1] and got["n_words"].tolist() == [17 * n + 1]
    assert [len(h) for _, h, _, _ in line_dedup._long_keys(text, 40)] == [1]
