"""The Merkle manifest against plain recursion; positions against a walk."""

import hashlib
import random
import string
import zlib

import duckdb
import pytest

from greenledger.llm import merkle, queries
from greenledger.llm.merkle import Shape

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climbed(nodes, fanout=16):
    """The root, and each leaf's siblings as (before, after) a level."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        upper, merged = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at:at + fanout]
            for k in range(len(run)):
                for i in groups[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            upper.append(h(*run))
            merged.append(sum(groups[at:at + fanout], []))
        nodes, groups = upper, merged
    return nodes[0], paths


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append((r, leaf(r[0], r[3], r[2], r[4], r[1])))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        members = sorted(sources[name], key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees.append((members, *climbed([x[1] for x in members])))
    root, above = climbed([t[1] for t in trees])
    out = []
    for (members, subroot, paths), top in zip(trees, above, strict=True):
        for (r, d), path in zip(members, paths, strict=True):
            path = path + top
            at = d
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                at = leaf(r[0], r[3], r[2], r[4], None if r[1] is None else r[1].translate(LOW))
            for before, after in path:
                at = h(before, at, after)
            out.append((r[0], d, subroot, root, h(*(x for pair in path for x in pair)), at, at == root))
    return sorted(out, key=repr)


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def walk(shape, leaves):
    """(level, i) in the order in which nodes are complete."""
    height, out = shape.height(leaves), []

    def visit(level, i):
        if level:
            for k in range(i * shape.fanout, min((i + 1) * shape.fanout, shape.width(leaves, level - 1))):
                visit(level - 1, k)
        out.append((level, i))

    visit(height, 0)
    return out


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_positions_are_those_of_the_walk(fanout):
    shape = Shape(fanout, 1)
    for leaves in [*range(1, 40), 256, 257, 300]:
        assert [shape.position(leaves, *node) for node in walk(shape, leaves)] == list(range(len(walk(shape, leaves))))


def rows_of(n, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(("Some Text", "plain", None, "", "Ünï")) and f"{rng.choice('AbC')} {i}", rng.choice(("en", None)),
             "hot" if rng.random() < 0.7 else rng.choice((None, "", "é", "z", "a")), i if i % 7 else None) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 16, 17, 700])
def test_proofs_are_brute_force(spark, n):
    rows = rows_of(n)
    got = merkle.document_proofs(made(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_builders_of_any_height_give_the_same(spark, levels):
    rows = rows_of(330, 2)
    got = merkle.document_proofs(made(spark, rows), Shape(16, levels))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_log_is_whole_and_in_postorder(spark):
    shape = Shape(4, 2)
    leaves = spark.createDataFrame([("t", i, h(str(i))) for i in range(137)] + [("u", 0, h("u"))], "tree string, doc_id long, leaf string")
    made_ = merkle.manifest(leaves, shape)
    log = {}
    for r in made_.rounds:
        for x in r.collect():
            assert log.setdefault((x.tree, x.position), (x.level, x.i, x.digest))[:2] == (x.level, x.i)
    nodes = walk(shape, 137)
    assert [log["t", k][:2] for k in range(len(nodes))] == nodes
    assert log["u", 0] == (0, 0, h("u")) and len(log) == len(nodes) + 1
    assert log["t", len(nodes) - 1][2] == climbed([h(str(i)) for i in range(137)], 4)[0]


def test_edges(spark, documents):
    assert merkle.document_proofs(documents([])).collect() == []
    rows = [(None, None, None, None, None), (None, "x", None, None, None), (3, "Rep", "en", "s", 3), (3, "Rep", "en", "s", 3),
            (3, "other", "en", "s", 5), (4, "L" * 200000, "en", "s", 200000), (5, "", "en", "s", 0)]
    assert sorted(map(tuple, merkle.document_proofs(made(spark, rows)).collect()), key=repr) == brute(rows)
    clash = merkle.document_proofs(documents([(1, "A"), (2, None)]))
    assert clash.count() == 2 and clash.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_query_is_its_sql_and_brute_force(spark, small):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS FROM '/root/testdata/sf0.001/documents.parquet'")
    got = queries.op13_merkle(spark, "/root/testdata/sf0.001")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.oracle_sql()['op13_merkle']})").fetchall()
    found = sorted(map(tuple, got.collect()), key=repr)
    assert found == sorted(want, key=repr)
    docs = small("documents", "/root/testdata/sf0.001").select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert found == brute([tuple(r) for r in docs])
    assert not all(r[-1] for r in found)
