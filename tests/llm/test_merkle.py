import hashlib
import zlib

import duckdb

from eventmart.llm import merkle as M
from tests.conftest import SF001
from tests.llm.cases import EDGES, edges, empty, rows_of


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves):
    """All levels of a tree."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([H(*row[i:i + 3]) for i in range(0, len(row), 3)])
    return levels


def path(levels, i):
    out = []
    for row in levels[:-1]:
        a = i // 3 * 3
        out.append((row[a:i], row[i + 1:a + 3]))
        i //= 3
    return out


def answer(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in groups[s]])
    forest = tree([trees[s][-1][0] for s in names])
    root, out = forest[-1][0], []
    for at, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            own = path(trees[s], i) + path(forest, at)
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                node = leaf((*r[:4], r[4] if r[4] is None else r[4].replace("\n", "")))
            for left, right in own:
                node = H(*left, node, *right)
            out.append((r[0], leaf(r), trees[s][-1][0], root, H(*[x for a, b in own for x in [*a, *b]]), node, node == root))
    return out


KEY = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def got_of(df, **more):
    even = lambda c: (M.F.crc32(c("doc_id").cast("string").cast("binary")) % 2 == 0)
    got = M.manifest(df, where=even, change={"text": lambda c: M.F.replace(c, M.F.lit("\n"), M.F.lit(""))}, **more)
    return sorted((tuple(r) for r in got.select(*NAMES).collect()), key=KEY)


def test_edges_and_repeated_rows(spark):
    rows = [(i, s, None if i == 3 else "en", None if t is None else len(t), t) for k, (i, t) in enumerate([*EDGES, (None, "no\nid"), (None, "no id")]) for s in [(None, "", "src", "Ünï")[k % 4]]]
    rows += [rows[5], rows[5], (77, "only", "x", 3, "a\nb")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree string")
    assert got_of(df) == sorted(answer(rows), key=KEY)
    assert M.manifest(empty(spark)).collect() == []


def test_sizes_around_blocks_and_a_hot_source(spark):
    """One leaf, runs of one and two, whole blocks and one more leaf, several layers; one source holds most."""
    sizes = {"one": 1, "two": 2, "three": 3, "four": 4, "block": M.BLOCK, "more": M.BLOCK + 1, "less": M.BLOCK - 1, "hot": M.BLOCK * M.BLOCK + 2}
    sizes |= {f"s{i}": 1 + i % 3 for i in range(M.BLOCK + 5)}
    rows, k = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((k * 7919 % 1_000_003, s, None, k, f"line {k}\nand" if k % 3 else f"line {k}"))
            k += 1
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(13)
    assert got_of(df) == sorted(answer(rows), key=KEY)


def test_versions_share_what_they_do_not_change():
    leaves = [H(str(i)).encode() for i in range(25)]
    block = M.Block(leaves, M.height(25))
    before = [list(x) for x in block.levels]
    version = block.version(13, H("new").encode())
    assert len(version) == M.height(25) + 1 and block.levels == before
    changed = list(leaves)
    changed[13] = version[0]
    other = M.Block(changed, M.height(25))
    assert version == [other.levels[k][13 // 3 ** k] for k in range(len(version))]
    differ = [(k, i) for k, row in enumerate(before) for i, x in enumerate(row) if x != other.levels[k][i]]
    assert differ == [(k, 13 // 3 ** k) for k in range(len(version))]
    assert M.unpacked(M.packed(block.path(13))) == block.path(13)


def test_ids_of_text_and_other_fields(spark):
    df = spark.createDataFrame([("b", "g", 1.5), ("a", "g", None), ("c", None, 2.0)], "name string, part string, value double")
    got = {r.name: r for r in M.manifest(df, fields=("name", "value"), group_column="part", id_column="name").collect()}
    a, b, c = leaf(("a", None)), leaf(("b", 1.5)), leaf(("c", 2.0))
    assert got["a"].root == got["c"].folded_root == H(c, H(a, b)) and got["c"].subroot == c and got["b"].proof_sha256 == H(a, c)
    assert all(r.verified and r.n_copied == 0 for r in got.values())


def test_query_and_its_sql(spark):
    got = sorted(tuple(r) for r in M.op12_merkle_manifest(spark, SF001).select(*NAMES).collect())
    assert got == sorted(answer(rows_of(SF001, "doc_id, source, lang, n_chars, text", "documents")))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{SF001}/documents.parquet')")
    assert got == sorted(con.sql(M.OP12_SQL).fetchall()) and 0 < sum(r[-1] for r in got) < len(got)
