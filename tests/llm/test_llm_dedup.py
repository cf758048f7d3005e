"""Exact copies, near copies, components and repeated passages against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from greenledger.llm import common, components, exact_dedup, minhash_dedup, suffix_dedup


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


# --- exact ------------------------------------------------------------------

ROWS = [(1, "Same"), (5, "same"), (9, "SAME"), (2, None), (3, ""), (4, "Ä"), (6, "ä"), (7, "x" * 50000), (8, "X" * 50000),
        (9, "SAME"), (None, "null id"), (None, "null id"), (None, "same"), (10, "same ")]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.substring(exact_dedup.sha256(c), 1, 0)])
def test_exact_dedup(documents, digest):
    got = exact_dedup.exact_dedup(documents(ROWS), digest=digest, salts=3).collect()
    want = []
    for i, text in ROWS:
        group = [j for j, other in ROWS if lower(other) == lower(text)]
        keep = max((j for j in group if j is not None), default=None)
        want.append((i, keep, len(group), i == keep, hashlib.sha256(lower(text).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_exact_dedup_of_nothing(documents):
    assert exact_dedup.exact_dedup(documents([])).collect() == []


# --- components -------------------------------------------------------------

def roots(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 60)] + [(200, 200)]
    pairs += [(rng.randint(300, 360), rng.randint(300, 360)) for _ in range(40)] + [(7, 1), (7, 1)]
    rng.shuffle(pairs)
    got = components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == roots(pairs)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- near -------------------------------------------------------------------

def near_brute(rows, k, percent=80):
    sets = {}
    for i, text in rows:
        w = [x for x in lower(text).replace("\n", " ").split(" ") if x]
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    links = set()
    for i, s in sets.items():
        shared = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        links |= {(j, i) for j, n in shared.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)}
    found = roots(links)
    return {i: (len(s), found.get(i, i)) for i, s in sets.items()}


def test_near_dedup_on_the_table(small):
    docs = small("documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = minhash_dedup.near_dedup(docs, minhash_dedup.Near(shingle=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_brute(rows, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_of_large_groups_and_chains(documents):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(60)]
    rows, n = [], 0
    for _ in range(150):  # many near copies of one text
        copy = list(base)
        copy[rng.randrange(60)] = word()
        rows.append((n, " ".join(copy)))
        n += 1
    chain = [word() for _ in range(80)]
    for step in range(12):  # each is near the next, the ends are not
        rows.append((n, " ".join(chain)))
        n += 1
        chain = chain[:6 * step] + [word() for _ in range(6)] + chain[6 * step + 6:]
    rows += [(n + 1, "Exact COPY of it"), (n + 2, "exact copy of it"), (n + 3, "one"), (n + 4, "ONE")]
    got = minhash_dedup.near_dedup(documents(rows), minhash_dedup.Near(shingle=2)).collect()
    want = near_brute(rows, 2)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < 15


def test_rounds_grow_with_the_logarithm_of_the_refuted(documents, monkeypatch):
    """One text is a little too far from each of 30 near copies: it is held against all of
    them, in a few rounds and not one round each."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10 ** 9)}" for _ in range(1500)]

    def changed(n):
        text = list(base)
        for at in rng.sample(range(0, 1500, 3), n):
            text[at] = f"v{rng.randrange(10 ** 9)}"
        return " ".join(text)

    rows = [(i, changed(2)) for i in range(30)] + [(99, changed(90))]
    names, stage = [], minhash_dedup.staged

    def noted(df, name):
        names.append(name)
        return stage(df, name)

    monkeypatch.setattr(minhash_dedup, "staged", noted)
    got = minhash_dedup.near_dedup(documents(rows), minhash_dedup.Near(shingle=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_brute(rows, 2)
    assert {r.component_id for r in got} == {0, 99}
    assert 2 <= names.count("closest") <= 6


def test_a_group_of_near_copies_is_connected_by_few_pairs(spark, documents, monkeypatch):
    """Each of 60 near copies is a component of its own at first: what is asked grows with
    the components of a bucket, not with its pairs, of which there are 1,770."""
    rng = random.Random(6)
    base = [f"w{rng.randrange(10 ** 9)}" for _ in range(80)]
    rows = [(i, " ".join([*base[:i], f"v{i}", *base[i + 1:]])) for i in range(60)]
    counts, stage, adaptive = [], minhash_dedup.staged, spark.conf.get("spark.sql.adaptive.enabled")

    def noted(df, name):
        out = stage(df, name)
        counts.extend([out.count()] if name == "closest" else [])
        return out

    monkeypatch.setattr(minhash_dedup, "staged", noted)
    monkeypatch.setattr(minhash_dedup, "ROUNDS", 0)
    got = minhash_dedup.near_dedup(documents(rows), minhash_dedup.Near(shingle=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_brute(rows, 2)
    assert 59 <= sum(counts) < 700
    assert spark.conf.get("spark.sql.adaptive.enabled") == adaptive


def test_only_buckets_that_hold_more_are_searched_again(documents, monkeypatch):
    """Far copies of two groups' first texts share buckets with many near copies and are
    refuted: later searches fetch members of the buckets that hold more than they gave, once."""
    rng = random.Random(8)
    rows, count = [], 60
    for group in range(2):
        base = [f"w{rng.randrange(10 ** 9)}" for _ in range(900)]

        def changed(n, base=base):
            text = list(base)
            for at in rng.sample(range(0, 900, 3), n):
                text[at] = f"v{rng.randrange(10 ** 9)}"
            return " ".join(text)

        rows += [(1000 * group + i, changed(2)) for i in range(count)]
        rows += [(1000 * group + 500 + i, changed(54 + i)) for i in range(3)]
    fetched, stage = [], minhash_dedup.staged

    def noted(df, name):
        out = stage(df, name)
        fetched.extend([out.count()] if name in ("among", "members") else [])
        return out

    monkeypatch.setattr(minhash_dedup, "staged", noted)
    got = minhash_dedup.near_dedup(documents(rows), minhash_dedup.Near(shingle=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_brute(rows, 2)
    assert len({r.component_id for r in got}) > 2
    assert sum(fetched[1:]) <= 1.2 * fetched[0]


def test_members_of_many_like_buckets_are_fetched_once(documents, monkeypatch):
    """Far copies of a text share most of their buckets with its many near copies: these
    are fetched for one search, not for each of the buckets."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(10 ** 9)}" for _ in range(900)]

    def changed(n):
        text = list(base)
        for at in rng.sample(range(0, 900, 3), n):
            text[at] = f"v{rng.randrange(10 ** 9)}"
        return " ".join(text)

    rows = [(i, changed(2)) for i in range(80)] + [(500 + i, changed(54 + i)) for i in range(4)]
    fetched, stage = [], minhash_dedup.staged

    def noted(df, name):
        out = stage(df, name)
        fetched.extend([out.count()] if name == "mixed" else [])
        return out

    monkeypatch.setattr(minhash_dedup, "staged", noted)
    got = minhash_dedup.near_dedup(documents(rows), minhash_dedup.Near(shingle=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_brute(rows, 2)
    assert len({r.component_id for r in got}) > 1
    assert fetched and max(fetched) <= 2 * len(rows)


def test_buckets_are_pooled_where_that_has_no_more_pairs(spark):
    """Buckets 1 and 2 hold the same but for a member; 11 to 13 hold little of a large component."""
    own = {n: 1 for n in range(1, 7)} | {n: 100 for n in range(100, 130)}
    buckets = {1: [1, 2, 3, 4, 5, 50, 51], 2: [1, 2, 3, 4, 6, 50, 51], 3: [100, 101],
               11: [100, 101, 60], 12: [102, 103, 61], 13: [104, 105, 62]}
    nodes = sorted({*own, *(n for b in buckets.values() for n in b)})
    sketches = spark.createDataFrame([(n, 7, [n], [n]) for n in nodes], "node long, n long, bits array<long>, hashes array<long>")
    members = spark.createDataFrame([(k, n) for k, b in buckets.items() for n in b], "key long, node long")
    got = minhash_dedup._mixed(members, sketches, spark.createDataFrame(list(own.items()), "node long, component long"))
    want = {(1, n, own.get(n, n), 1, 2, 8) for n in [1, 2, 3, 4, 5, 6, 50, 51]}
    want |= {(k, n, own.get(n, n), 100, 1, 3) for k in (11, 12, 13) for n in buckets[k]}
    rows = [tuple(r) for r in got.select("key", "node", "own", "main", "outside", "size").collect()]
    assert len(rows) == len(want) and set(rows) == want


def test_a_key_needs_a_hash_of_both_collections():
    own = np.array([1, 2, 3, 4])
    hashes = np.array([[1, 0, 0, 4], [1, 2, 0, 0], [0, 0, 3, 4], [2, 1, 4, 3], [1, 2, 3, 4]])
    assert minhash_dedup.share_a_key(hashes, own).tolist() == [True, False, False, False, True]


def test_forests_keep_what_connects():
    rng = random.Random(9)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(600)]
    for n in (1, 3):
        graph, taken = minhash_dedup.Forests(n), []
        for a in range(40):
            ends = np.array([y for x, y in edges if x == a and y != a], dtype=np.int64)
            taken += [(a, int(ends[i])) for i in graph.add(a, graph.places(ends))]
        assert roots(taken) == roots([e for e in edges if e[0] != e[1]]) and len(taken) <= 39 * n


def test_bitmaps_differ_in_no_more_bits_than_their_sets():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2 ** 63, 400, dtype=np.int64).astype(np.uint64)
    for k in range(0, 40, 2):
        a, b = np.unique(pool[:300]), np.unique(pool[k:300 + k])
        maps = np.stack([minhash_dedup.parities(b)])
        assert minhash_dedup.differing_bits(maps, minhash_dedup.parities(a))[0] <= len(np.setxor1d(a, b))


def test_first_places_of_each_value():
    got = minhash_dedup._first_of_each(np.array([5, 3, 5, 5, 3, 7]), 2)
    assert sorted(got.tolist()) == [0, 1, 2, 4, 5]


def test_near_dedup_edges(documents):
    rows = [(1, None), (2, ""), (3, " \n "), (None, "a b c"), (4, "a b c"), (4, "a b c"), (5, "A B c"), (6, "z " * 30000)]
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_dedup(documents(rows)).collect()}
    assert got == {(1, 1, True), (2, 2, True), (3, 3, True), (None, None, True), (4, 4, True), (5, 4, False), (6, 6, True)}
    assert minhash_dedup.near_dedup(documents([])).collect() == []


def test_tensored_keys_find_near_sets():
    near = minhash_dedup.Near()
    sketch = minhash_dedup.Sketch(near)
    rng = np.random.default_rng(0)
    hits = 0
    for _ in range(400):
        pool = rng.integers(0, 2 ** 63, 200, dtype=np.int64).astype(np.uint64)
        a, b = pool[:180], pool[20:]  # similarity 0.8
        u, v = sketch.collections(np.unique(a)), sketch.collections(np.unique(b))
        same = u == v
        hits += same[:near.bands].any() and same[near.bands:].any()
    assert hits >= 396


# --- repeated passages ------------------------------------------------------

def passages_brute(rows, length=50):
    first = {}
    data = sorted((i, (t or "").encode()) for i, t in rows if i is not None)
    for i, b in data:
        for s in range(len(b) - length + 1):
            first.setdefault(b[s:s + length], i)
    out = {}
    for i, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < i:
                gone[s:s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(gone)))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check_passages(df, rows):
    got = suffix_dedup.remove_repeats(df).collect()
    want = passages_brute(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got if r.doc_id is not None} == want
    return got


def test_passages_of_the_table(small, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 1 << 15)  # many parts and buckets
    monkeypatch.setattr(suffix_dedup, "BUCKET_ANCHORS", 1 << 8)
    docs = small("documents", "/root/testdata/sf0.001")
    check_passages(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_passages_by_hand(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 1 << 12)
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("ab é") for _ in range(n))
    shared = [text(n) for n in (49, 50, 51, 120, 700)]
    rows = [(i, text(rng.randint(0, 80)) + rng.choice(shared) + text(rng.randint(0, 30)) + rng.choice(shared))
            for i in range(120)]
    rows += [(200, "a" * 400), (201, "a" * 60), (202, "a" * 49), (203, None), (204, ""), (205, shared[4]),
             (206, shared[4]), (206, shared[4]), (207, shared[3] * 5), (None, shared[4]), (208, text(60000))]
    got = check_passages(documents(rows), rows)
    assert [r.n_removed for r in got if r.doc_id is None] == [0]
    assert suffix_dedup.remove_repeats(documents([])).collect() == []


def test_removed_text_can_be_kept(documents):
    line = "this line is longer than fifty bytes, so that it counts as a passage"
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(
        documents([(1, line), (2, f"before {line} after")]), keep_text=True).collect()}
    assert got[1].kept_text == line
    (a, b), = got[2].spans
    assert f"before {line} after"[a:b] == f"{line}"[:b - a] and got[2].n_removed == b - a


def test_blind_trie_orders_and_groups():
    rng = random.Random(2)
    values = [rng.getrandbits(40) >> rng.choice((0, 20, 35)) for _ in range(500)]
    trie = suffix_dedup.BlindTrie(40)
    for i, v in enumerate(values):
        trie.add(v, i)
    found = [sorted({values[i] for i in leaf}) for leaf in trie.leaves()]
    assert found == [[v] for v in sorted(set(values))]
    assert sorted(i for leaf in trie.leaves() for i in leaf) == list(range(500))


def test_deep_shallow_sort_groups_equal_windows():
    rng = random.Random(3)
    piece = bytes(rng.choice(b"ab") for _ in range(90))
    buffer = piece + b"x" + piece[10:80] + b"y" * 70 + piece[:55]
    starts = np.arange(len(buffer) - 49)
    want = {}
    for s in starts.tolist():
        want.setdefault(buffer[s:s + 50], []).append(s)
    got = [sorted(g) for g in suffix_dedup.equal_windows(buffer, starts, 50)]
    assert sorted(got) == sorted(g for g in want.values() if len(g) > 1)
    assert [buffer[g[0]:g[0] + 50] for g in got] == sorted(buffer[g[0]:g[0] + 50] for g in got)


# --- helpers ----------------------------------------------------------------

def test_attach_gives_every_row_its_key(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("k"))
    table = left.groupBy("k").agg(F.count(F.lit(1)).alias("size"))
    got = common.attach(left, table, ["k"], "id", salts=4).collect()
    assert len(got) == 1000 and all(r["size"] == (700 if r.k == 1 else 1) for r in got)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())
