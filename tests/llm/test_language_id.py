import zlib

import pyarrow as pa

from eventmart.llm import language_id as L
from tests.conftest import SF001, SF01
from tests.llm.cases import EDGES, edges, empty, rows_of

SAMPLES = {"en": "the cat sat on the mat and then the dog came to the house where they lived ", "de": "der hund und die katze leben in einem haus mit garten und die kinder spielen ",
           "fr": "le chat et le chien vivent dans une maison avec un jardin où les enfants jouent ", "ru": "кошка и собака живут в доме с садом где играют дети и все рады "}
TEXTS = {k: (v * 3).encode() for k, v in SAMPLES.items()}


def plain(text):
    for s in L.slices(L.lowered(pa.array([text], pa.string()))):
        return L.symbols(s)[0].tobytes()


def phrases(text: bytes, learned: bytes) -> int:
    """Phrases of a text, segment by segment, by looking for substrings."""
    n = 0
    for k in range(0, len(text), L.SEGMENT):
        part, i = text[k:k + L.SEGMENT], 0
        while i < len(part):
            m = 1
            while i + m < len(part) and part[i:i + m + 1] in learned:
                m += 1
            i, n = i + m, n + 1
    return n


def test_automaton_has_all_substrings_and_no_others():
    for text in (b"abcbc", b"aabbabd", b"aaaa", b"", b"mississippi", TEXTS["fr"]):
        edges_ = L.suffix_automaton(text)
        base, check, target = L._double_array(edges_)
        for s, own in enumerate(edges_):
            assert {a: int(target[base[s] + a]) for a in range(256) if check[base[s] + a] == s} == own
        for i in range(min(len(text), 40)):
            state = 0
            for a in text[i:]:
                state = edges_[state][a]


def test_phrases_equal_substring_search():
    parser = L.Parser.of(TEXTS)
    texts = [t for _, t in EDGES] + list(SAMPLES.values()) + ["", None, "ÀÉ 123 où", "кот и дом", "日本語", "x" * 1500]
    count, size = parser.counts(pa.array(texts, pa.string()).fill_null(""))
    for i, t in enumerate(texts):
        got = plain(t or "")
        if len(got) < 5000:
            assert size[i] == len(got)
            assert count[:, i].tolist() == [phrases(got, TEXTS[x]) for x in parser.names]


def test_edges_and_samples(spark):
    rows = [*EDGES, (100, SAMPLES["de"].upper()), (101, "1234 !!"), (None, SAMPLES["ru"]), (102, "où est le jardin")]
    got = {r.doc_id: r for r in L.identify(edges(spark, rows), texts=TEXTS).collect()}
    assert (got[100].lang_pred, got[None].lang_pred, got[102].lang_pred) == ("de", "ru", "fr") and not got[None].held_out
    for i in (0, 1, 2, 101, 14):
        t = dict(rows)[i]
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= got[i].score <= 1
    assert got[0].score == 0 and got[100].score > 0.9
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items() if i is not None)
    assert len(L.identify(edges(spark, rows), texts=TEXTS).collect()) == len(rows)


def test_empty_and_unlabelled(spark):
    assert L.identify(empty(spark)).collect() == []
    assert {r.lang_pred for r in L.identify(edges(spark)).collect()} == {"und"}


def test_very_long_text(spark):
    long = SAMPLES["en"] * 60_000                         # 4.5 MB
    got = L.identify(edges(spark, [(1, long), (2, SAMPLES["fr"])]), texts=TEXTS).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "en", 2: "fr"}


def test_never_learns_from_the_held_out_fold(spark):
    rows = [(i, f"zz{'q' * (i % 5)} word", "aa") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = df.filter("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1")
    assert L.training_texts(held) == {} and set(L.training_texts(df)) == {"aa"}
    many = L.training_texts(df, max_rows=10, max_bytes=2000)
    assert len(many["aa"]) <= 2000 and many == L.training_texts(df.repartition(7), max_rows=10, max_bytes=2000)


def test_query_on_held_out_documents(spark):
    for path, least in ((SF001, 0.97), (SF01, 0.985)):
        lang = dict(rows_of(path, "doc_id, lang", "documents"))
        got = L.op11_language_id(spark, path).collect()
        assert sorted(r.doc_id for r in got) == sorted(lang)
        held = [r for r in got if r.held_out]
        assert len(held) > 50 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= least * len(held)
