"""Small tables with the awkward cases every text operator has to take, and plain-Python answers."""

from __future__ import annotations

import re
from collections import Counter

import duckdb

LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(30_000)) + "\nthe last line of a very long text, which others hold as well"
SHARED = "This line is shared by many documents, and longer than forty characters."
EDGES = [
    (0, None), (1, ""), (2, " \t\n\x0b "), (3, "one"), (4, LONG),
    (5, f"first\n{SHARED}\nfirst\n{SHARED}"), (6, f"  {SHARED.upper()}\t\nsix"), (7, f"{SHARED}\nseven"), (8, SHARED),
    (9, f"x\n{SHARED}\r\ny"), (10, f"{SHARED}"), (11, "Ünïcödé Straße ΑΒΓ 日本語 é\n\nno break"), (12, "a b c d e f g h"), (13, "A b c d e f g h"),
    (14, "#$% *** | <tag> & ##"), (15, "same words same words same words same words"), (-3, "negative id, with words"), (8, SHARED), (16, "a\x00b\x1cc d"),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept int, size string, _text string, node double, hit string"


def edges(spark, rows=EDGES):
    """The cases with other columns whose names operators might use themselves."""
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), 7, "big", "x", 1.5, None) for i, t in rows], COLUMNS)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def rows_of(path: str, columns: str, name: str) -> list[tuple]:
    return duckdb.sql(f"select {columns} from read_parquet('{path}/{name}.parquet')").fetchall()


WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def base_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    three = Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
    hit = {j + k for j in range(len(w) - 2) if three[tuple(w[j:j + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def line_answer(rows: list[tuple], min_chars: int = 40, min_docs: int = 5) -> list[tuple]:
    """(doc_id, n_lines, n_dropped, kept text) of each row."""
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    held: dict[str, set] = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < min_docs or i == max(held[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text: str | None, n: int) -> frozenset:
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def component_answer(rows: list[tuple], n: int = 4, percent: int = 85) -> list[tuple]:
    """(doc_id, set size, component_id) of each row, from all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    home = list(range(len(rows)))

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    holders: dict = {}
    for k, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    for k, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j < k}:
            o = len(s & sets[j])
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                home[find(j)] = find(k)
    least: dict = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows))


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leak_answer(rows: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    """(doc_id, n_words, n_hit, items, contaminated) of each row."""
    windows: dict = {}
    for item, t in items:
        w = ITEM_WORD.findall(lower(t))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, t in rows:
        w = ITEM_WORD.findall(lower(t))
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (ids := windows.get(tuple(w[k:k + size]))) is not None:
                    hit.update(range(k, k + size))
                    found |= ids
        out.append((i, len(w), len(hit), ",".join(sorted(found)), bool(hit)))
    return out
