"""Near duplicates by MinHash with tensored banding.

Two small collections of ``bands`` hashes, each hash made of ``rows`` minhashes,
are computed per document; every pair of a hash from the first and a hash from
the second collection is a table key. bands * bands keys thus cost only
2 * bands * rows minhashes. Documents that share a key are candidates.

Candidates are never expanded into all pairs. A few rounds compare each document
with one leader of its buckets, on the full shingle sets, and connect what is
similar; a document is only ever compared with a leader of another component.
Then buckets whose members are still in different components are searched: a
block of members outside the bucket's main component is held against the whole
bucket by bitmaps of the sets. Buckets with the same main component hold much the same
members and are searched as one, where that has fewer pairs to look at. What may be similar makes a graph of the bucket's
components, of which a task gives a spanning forest, and in later searches several
forests without a common pair. All these pairs are confirmed on the full sets, refuted,
or have their ends connected by others. Buckets that hold more than they gave are
searched again, among the components that their pairs were to connect and did not,
until nothing is left to ask. So every candidate pair is confirmed,
refuted or connected, and what leaves a task grows with the components in a bucket,
not with its pairs. Links connect components that are known already, so later rounds
connect few. The bitmaps lose nothing: two sets differ in at least as many elements as the
parity bits of their elements do.
"""

from __future__ import annotations

import hashlib
import string
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe_vocab import Remembered
from .common import SALTS, arrow_rows, attach, planned_once, prepare, salt, scratch, staged
from .components import connected_components

#: Rounds of comparisons with one leader, and words of 64 bits of a set's bitmap.
ROUNDS, BITMAP = 2, 16

#: Members that a task holds against a bucket, and rows of the bucket that pass it.
BLOCK, STRETCH = 256, 8192

#: Forests that a task gives in a search, after the first one, and pairs of two components that
#: are asked at once: one at first, then ``MORE`` times as many each time.
FORESTS, MORE = 512, 64

_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


@dataclass(frozen=True)
class Near:
    """Words of a shingle, the least similarity in percent, hashes of each of the
    two collections and minhashes of each hash. With 10 and 3, a pair at the
    least similarity of 0.8 shares a key with probability 0.9985, at 0.9 with
    0.999996."""

    shingle: int = 5
    percent: int = 80
    bands: int = 10
    rows: int = 3


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII spaces, A-Z lower-cased."""
    return (text or "").encode().translate(_LOWER).split()


def shingles(words: list[bytes], k: int) -> set:
    """Distinct runs of k words; fewer words count as one run; none give none."""
    if len(words) <= k:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(k)), strict=False))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class Sketch:
    def __init__(self, near: Near) -> None:
        self.near = near
        self.words = Remembered(xxhash.xxh3_64_intdigest)
        n = 2 * near.bands * near.rows
        seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * _M1)
        self.a, self.b = seeds[:n] | np.uint64(1), seeds[n:]

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles."""
        w = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        k = min(self.near.shingle, len(w))
        if not k:
            return w
        h = np.full(len(w) - k + 1, np.uint64(k))
        for i in range(k):
            h = mix(h * _M1 + w[i:len(w) - k + 1 + i])
        return np.unique(h)

    def collections(self, hashes: np.ndarray) -> np.ndarray:
        """The 2 * bands hashes of a set, as signed 64-bit integers."""
        least = np.full(len(self.a), np.iinfo(np.uint64).max)
        for at in range(0, len(hashes), 1024):  # long texts: a block at a time
            least = np.minimum(least, (hashes[at:at + 1024, None] * self.a + self.b).min(axis=0))
        out = np.zeros(2 * self.near.bands, dtype=np.uint64)
        for column in least.reshape(-1, self.near.rows).T:
            out = mix(out * _M1 + column)
        return out.view(np.int64)


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each bit of the bitmap whether an odd number of elements falls on it."""
    size = 64 * BITMAP
    odd = np.bincount((hashes % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def differing_bits(maps: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """In how many bits each of ``maps`` differs from ``bits``; counted unsigned, as of a
    negative integer numpy counts the bits of its absolute value."""
    return np.bitwise_count((maps ^ bits).view(np.uint64)).sum(axis=1, dtype=np.int64)


def shingle_sets(docs: DataFrame, near: Near) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, hashes, bitmap) of every row."""

    def run(batches):
        sketch = Sketch(near)
        for batch in batches:
            sizes, digests, keys, bits = [], [], [], []
            for text in batch.column(1).to_pylist():
                h = sketch.hashes(words_of(text))
                sizes.append(len(h))
                digests.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                keys.append(sketch.collections(h) if len(h) else None)
                bits.append(parities(h) if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "hashes", "bits"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary, hashes array<long>, bits array<long>")


def key_of(u: str, v: str, i: str, j: str) -> str:
    return f"xxhash64({u}, {v}, {i}, {j})"


def share_a_key(hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which of ``hashes``, of a node each, share a hash of both collections with ``own``, and so a key."""
    first, second = np.split(hashes == own, 2, axis=1)
    return first.any(axis=1) & second.any(axis=1)


def bucket_members(nodes: DataFrame, near: Near) -> DataFrame:
    """(key, node, leader, edge) of every key that two nodes may share. Keys are
    dealt out in ranges of (key, node), so that a hot key spans several tasks:
    each has its own leader, its least node there, and the leaders at a task's
    edges are marked."""
    t = near.bands
    tensor = F.expr(f"flatten(transform(slice(hashes, 1, {t}), (x, i) -> transform("
                    f"slice(hashes, {t + 1}, {t}), (y, j) -> {key_of('x', 'y', 'i', 'j')})))")
    rows = nodes.select(F.explode(tensor).alias("key"), "node")
    rows = rows.repartitionByRange("key", "node").sortWithinPartitions("key", "node")

    def run(batches):
        leader, last = None, None  # of the run that the previous batch ended in
        held = None  # the only row so far of that run, not yet given out: (key, node, first of the task)

        def out(key, node, leader, edge):
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(leader), pa.array(edge)],
                                              ["key", "node", "leader", "edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            new = np.r_[last is None or key[0] != last, key[1:] != key[:-1]]
            start = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            leaders = np.where(start >= 0, node[np.maximum(start, 0)], leader if leader is not None else 0)
            if held is not None and (held[2] or not new[0]):  # the task's first run, or it goes on here
                yield out([held[0]], [held[1]], [held[1]], [held[2]])
            held = None
            shared = ~new
            shared[:-1] |= ~new[1:]
            edge = np.zeros(len(key), dtype=bool)
            if last is None:
                shared[0] = edge[0] = True
            if new[-1]:  # whether its run goes on is not known yet
                held = (key[-1], node[-1], bool(edge[-1]))
                shared[-1] = False
            last, leader = key[-1], leaders[-1]
            yield out(key[shared], node[shared], leaders[shared], edge[shared])
        if held is not None:
            yield out([held[0]], [held[1]], [held[1]], [True])
        elif last is not None:  # the last run's leader once more, as an edge
            yield out([last], [leader], [leader], [True])

    return rows.mapInArrow(run, "key long, node long, leader long, edge boolean")


@contextmanager
def by_id(docs: DataFrame, ids: DataFrame):
    """The texts of ``ids`` as a table bucketed by id in the shared folder, so that
    joins with it move the other side only; the name goes with the block."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"llm_texts_{uuid.uuid4().hex[:12]}"
    rows = docs.repartition(n, "doc_id").join(ids.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    (rows.write.bucketBy(n, "doc_id").option("path", scratch(spark, "texts") + "/table")
     .option("compression", "zstd").saveAsTable(name))
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def confirmed(pairs: DataFrame, docs: DataFrame, near: Near) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full shingle sets are similar enough. A task
    holds one set at a time; the partners of a hot ``a`` are dealt out."""
    pairs = pairs.select("a", "b", salt(F.col("b"), SALTS).alias("part"))
    asked = pairs.select("a", "part", F.col("b").alias("doc_id"), F.lit(1).alias("kind")).unionByName(
        pairs.select("a", "part").distinct().select("a", "part", F.col("a").alias("doc_id"), F.lit(0).alias("kind")))
    rows = (asked.join(docs, "doc_id").select("a", "part", "kind", F.col("doc_id").alias("b"), "text")
            .repartition("a", "part").sortWithinPartitions("a", "part", "kind", "b"))

    def run(batches):
        own, mine = None, set()
        for batch in batches:
            found = []
            for a, kind, b, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                theirs = shingles(words_of(text), near.shingle)
                if kind == 0:
                    own, mine = a, theirs
                elif own == a:
                    both = len(mine & theirs)
                    if 100 * both >= near.percent * (len(mine) + len(theirs) - both) and both:
                        found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                              pa.array([x for _, x in found], pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def near_dedup(docs: DataFrame, near: Near = Near(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Texts without words (null, empty, white space) have an empty set and are
    linked with nothing. Rows that share an id are one document. A row with a null
    id is linked with nothing: null component, kept. Of a component the smallest
    id is kept. Other columns are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    sets = staged(shingle_sets(texts, near), "shingle-sets")
    linked = sets.filter("doc_id IS NOT NULL AND n_shingles > 0")
    least = linked.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))  # equal sets are one node
    sketches = staged(linked.join(least, ["digest", "doc_id"]).dropDuplicates(["digest", "doc_id"])
                      .withColumnsRenamed({"doc_id": "node", "n_shingles": "n"}), "sketches")
    with arrow_rows(spark, 20_000):
        members = staged(bucket_members(sketches, near), "buckets")
    # The leaders of one key's ranges, at the edges of tasks: two rows a task.
    edges = members.filter("edge").select("key", F.col("leader").alias("node"))
    across = edges.join(edges.groupBy("key").agg(F.min("node").alias("leader")), "key").select("leader", "node")
    offers = members.select("leader", "node").union(across).filter("leader <> node")
    with by_id(texts, sketches) as texts:
        labels = _components(offers, members, sketches, texts, near)
    by_digest = sketches.join(labels, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component_id"))
    joined = attach(linked.select("doc_id", "n_shingles", "digest"), by_digest, ["digest"], "doc_id")
    alone = sets.filter("doc_id IS NULL OR n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.drop("digest").unionByName(alone).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _components(offers: DataFrame, members: DataFrame, sketches: DataFrame, texts: DataFrame,
                near: Near) -> DataFrame:
    """(node, component) of all nodes with links."""
    spark, labels = texts.sparkSession, None
    for k in range(ROUNDS):
        pairs = staged(_one_leader(offers, labels, k), "leaders")
        if pairs.isEmpty():
            break
        labels = _connected(labels, pairs, staged(confirmed(pairs, texts, near), "links"))
    asked, refuted, forests = staged(_mixed(members, sketches, labels), "mixed"), None, 1
    while True:
        nearest = _closest(asked, refuted, near, forests)
        labels, refuted = _settled(nearest, labels, refuted, texts, near, min(forests, MORE))
        parts = _open_parts(nearest, labels)
        if parts is None:
            break
        forests = FORESTS
        asked = staged(_still_mixed(asked, parts, labels), "mixed")
    if labels is None:
        labels = sketches.select("node", F.col("node").alias("component")).limit(0)
    return labels


def _settled(nearest: DataFrame, labels: DataFrame | None, refuted: DataFrame | None, texts: DataFrame,
             near: Near, most: int) -> tuple[DataFrame | None, DataFrame | None]:
    """``labels`` and ``refuted`` (a, b) once every pair that the buckets gave is confirmed, refuted or
    inside a component. Of two components the ``most`` closest pairs are asked at first and ``MORE``
    times as many each time."""
    spark = texts.sparkSession
    given = nearest.filter("one IS NOT NULL").select(
        "one", "two", "differ", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    while True:
        with planned_once(spark):
            pairs = staged(_of_components(given, most), "closest")
        if pairs.isEmpty():
            return labels, refuted
        found = staged(confirmed(pairs, texts, near), "links")
        with planned_once(spark):
            wrong = staged(pairs.join(found, ["a", "b"], "left_anti").select("a", "b"), "refuted")
        if not found.isEmpty():
            labels = _connected(labels, pairs, found)
        if wrong.isEmpty():  # the closest pair of any two components connects them
            return labels, refuted
        refuted = wrong if refuted is None else refuted.union(wrong)
        with planned_once(spark):
            rest = given.dropDuplicates(["a", "b"]).join(pairs.select("a", "b"), ["a", "b"], "left_anti")
            given = staged(_apart(rest, labels, "a"), "given")
        if given.isEmpty():
            return labels, refuted
        most *= MORE  # so that rounds grow with the logarithm of what is refuted


def _apart(pairs: DataFrame, labels: DataFrame | None, spread: str) -> DataFrame:
    """Those of ``pairs`` whose components ``one`` and ``two`` are not connected by now, with what
    they have become."""
    pairs = pairs.withColumnsRenamed({"one": "_one", "two": "_two"})
    now = _owned(_owned(pairs, labels, "_one", spread, "one"), labels, "_two", spread, "two")
    return now.filter("one <> two").drop("_one", "_two")


def _open_parts(nearest: DataFrame, labels: DataFrame | None) -> DataFrame | None:
    """(key, own): the components that a bucket's pairs, all asked by now, have left apart, of
    buckets that hold more than they gave; None if there are none. Any two members of a bucket that
    may be similar are connected by pairs that it gave, so that no other component has one left."""
    more = nearest.filter("one IS NULL").select("key").distinct()
    if more.isEmpty():
        return None
    given = nearest.filter("one IS NOT NULL").select("key", "one", "two").distinct()
    apart = _apart(attach(given, more, ["key"], "one"), labels, "key")
    parts = staged(apart.select("key", F.col("one").alias("own")).union(apart.select("key", "two")).distinct(), "parts")
    return None if parts.isEmpty() else parts


def _connected(labels: DataFrame | None, pairs: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` (node, component) after those of ``pairs`` (a, b, one, two) that were
    ``found`` connect their components ``one`` and ``two``. Each pair of components is one
    link, however many pairs of members it has."""
    links = pairs.join(found, ["a", "b"]).select(F.col("one").alias("a"), F.col("two").alias("b")).distinct()
    merged = connected_components(links)
    if labels is None:
        return merged
    known = attach(labels, merged.toDF("component", "into"), ["component"], "node", "left")
    # a component is named by a node of it, so that its own row comes from both
    with planned_once(labels.sparkSession):
        return staged(known.select("node", F.coalesce("into", "component").alias("component")).union(merged).distinct(), "labels")


def _owned(rows: DataFrame, labels: DataFrame | None, column: str, spread: str, name: str) -> DataFrame:
    """``rows`` with the component of ``column``; one without links is its own."""
    if labels is None:
        return rows.withColumn(name, F.col(column))
    known = labels.select(F.col("node").alias(column), F.col("component").alias(name))
    return attach(rows, known, [column], spread, "left").withColumn(name, F.coalesce(name, column))


def _one_leader(offers: DataFrame, labels: DataFrame | None, k: int) -> DataFrame:
    """(a, b, one, two): for each node b one of its leaders in another component, in the
    first round the least, then another one each round, and the components of both."""
    if labels is None:
        offers = offers.select("*", F.col("leader").alias("_theirs"), F.col("node").alias("_own"))
    else:
        offers = _owned(_owned(offers, labels, "leader", "node", "_theirs"), labels, "node", "leader", "_own")
        offers = offers.filter("_theirs <> _own")
    order = F.xxhash64("leader", F.lit(k)) if k else F.col("leader")
    return offers.groupBy("node").agg(F.min(F.struct(order.alias("o"), "leader", "_theirs", "_own")).alias("x")).select(
        F.col("x.leader").alias("a"), F.col("node").alias("b"), F.col("x._theirs").alias("one"), F.col("x._own").alias("two"))


def _mixed(members: DataFrame, sketches: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(key, node, own, main, outside, size, n, bits, hashes) of the buckets in ``members`` (key,
    node) that hold several components: the member's own and the bucket's largest,
    its members and those outside the largest. Buckets of one main component are pooled."""
    spark = sketches.sparkSession
    parts = staged(_parts(_owned(members.select("key", "node").distinct(), labels, "node", "key", "own")), "parts")
    keys = staged(_several(parts), "keys")
    with planned_once(spark):
        nodes = staged(_owned(sketches.select("node"), labels, "node", "node", "own"), "nodes")
        pools, apart = _pools(parts, keys, nodes)
    pooled = attach(nodes, pools, ["own"], "node")
    rest = _owned(attach(members.select("key", "node"), apart, ["key"], "node").distinct(), labels, "node", "key", "own")
    rows = staged(pooled.unionByName(rest), "members")
    return attach(rows, sketches.select("node", "n", "bits", "hashes"), ["node"], "key")


def _pools(parts: DataFrame, keys: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, own, main, outside, size) of pools, and those of ``keys`` that are in none. A pool has
    all members of the components in the buckets of one main component, which hold much the same members
    over and over. It is made where it has no more pairs to hold against each other than its buckets
    have in all; it has no more members than these then, as it has all that is outside in any of them."""
    near = attach(parts.select("key", "own"), keys.select("key", "main"), ["key"], "own").select("main", "own").distinct()
    near = staged(attach(near, nodes.groupBy("own").agg(F.count(F.lit(1)).alias("members")), ["own"], "main"), "near")
    pools = near.groupBy("main").agg(
        F.sum("members").alias("size"), F.sum(F.when(F.col("own") != F.col("main"), F.col("members"))).alias("outside"))
    held = keys.groupBy("main").agg(F.min("key").alias("key"), F.sum(F.col("size").cast("double") * F.col("outside")).alias("pairs"))
    pools = pools.join(held, "main").filter(F.col("size").cast("double") * F.col("outside") <= F.col("pairs")).drop("pairs")
    pools = staged(pools, "pools")
    apart = attach(keys, pools.select("main", F.lit(True).alias("pooled")), ["main"], "key", "left").filter("pooled IS NULL").drop("pooled")
    return staged(attach(near.drop("members"), pools, ["main"], "own"), "pooled"), staged(apart, "apart")


def _still_mixed(mixed: DataFrame, among: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``mixed`` after ``labels`` have changed, of the buckets and components in ``among`` (key,
    own) alone. Components of a bucket are chosen before their members, so that a large one that
    few buckets ask for is not fetched from all."""
    parts = _owned(_parts(mixed).withColumnRenamed("own", "was"), labels, "was", "key", "own")
    parts = staged(attach(parts, among, ["key", "own"], "was"), "parts")
    chosen = attach(parts.select("key", "was", "own"), staged(_several(parts), "keys"), ["key"], "was")
    rows = mixed.select("key", "node", F.col("own").alias("was"), "n", "bits", "hashes")
    return attach(rows, chosen, ["key", "was"], "node").drop("was")


def _parts(rows: DataFrame) -> DataFrame:
    """(key, own, size, x): a bucket's components, their members and a checksum of these."""
    return rows.groupBy("key", "own").agg(F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("x"))


def _several(parts: DataFrame) -> DataFrame:
    """(key, main, outside, size) of the buckets that hold several components. Of buckets with the
    same members one is left."""
    parts = parts.groupBy("key", "own").agg(F.sum("size").alias("size"), F.sum("x").alias("x"))
    keys = parts.groupBy("key").agg(F.max_by("own", F.struct("size", "own")).alias("main"), F.count(F.lit(1)).alias("parts"),
                                    F.max("size").alias("most"), F.sum("size").alias("size"), F.sum("x").alias("x"))
    keys = keys.filter("parts > 1").groupBy("size", "x").agg(F.min(F.struct("key", "main", "most")).alias("k"))
    return keys.select("k.key", "k.main", (F.col("size") - F.col("k.most")).alias("outside"), "size")


def _closest(mixed: DataFrame, refuted: DataFrame | None, near: Near, forests: int = 1) -> DataFrame:
    """(key, one, two, differ, a, b): pairs of members and their components, so that components
    whose members share a key, may be similar enough, by their bitmaps, and are not refuted are connected in
    each bucket: ``forests`` times over, where there are as many pairs. A row of the key alone
    stands for what a bucket holds beyond that."""
    blocks, stretches = F.ceil(F.col("outside") / BLOCK).cast("int"), F.ceil(F.col("size") / STRETCH).cast("int")
    block, stretch = salt(F.col("node"), blocks), salt(F.xxhash64("node", F.lit(1)), stretches)

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    facts = ["key", "node", "own", "n", "bits", "hashes"]
    nothing = F.array().cast("array<long>").alias("refuted")
    held = mixed.filter("own <> main").select(*facts, block.alias("block"), every(stretches).alias("stretch"))
    if refuted is None:
        held = held.select("*", nothing)
    else:
        both = refuted.union(refuted.select("b", "a")).groupBy(F.col("a").alias("node")).agg(F.collect_set("b").alias("known"))
        held = attach(held, both, ["node"], "key", "left").withColumn("refuted", F.coalesce("known", F.array().cast("array<long>"))).drop("known")
    passing = mixed.select(*facts, every(blocks).alias("block"), stretch.alias("stretch"), nothing)
    rows = held.withColumn("kind", F.lit(0)).unionByName(passing.withColumn("kind", F.lit(1)))
    order = ["key", "block", "stretch"]
    rows = (rows.select(*order, "kind", "node", "own", "n", "bits", "hashes", "refuted").repartition(*order)
            .sortWithinPartitions(*order, "kind", "node"))

    def run(batches):
        group, found, mine, graph = None, [], [], Forests(forests)
        for batch in batches:
            if not batch.num_rows:
                continue
            key, part, turn, kind, node, own, n = (batch.column(i).to_numpy() for i in range(7))
            bits = batch.column(7).flatten().to_numpy().reshape(-1, BITMAP)
            hashes = batch.column(8).flatten().to_numpy().reshape(-1, 2 * near.bands)
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (turn[1:] != turn[:-1])])
            for start, end in zip(starts, [*starts[1:], len(key)], strict=True):
                if group != (key[start], part[start], turn[start]):
                    group, mine, graph = (key[start], part[start], turn[start]), [], Forests(forests)
                middle = start + int((kind[start:end] == 0).sum())
                for i in range(start, middle):
                    known = np.array(batch.column(9)[i].as_py(), np.int64)
                    mine.append((int(node[i]), int(own[i]), n[i], bits[i].copy(), hashes[i].copy(), known))
                if middle == end:
                    continue
                cut = False
                theirs, sizes, comps, maps, keys = (x[middle:end] for x in (node, n, own, bits, hashes))
                places = graph.places(comps)
                for a, a_own, a_n, a_bits, a_hashes, known in mine:
                    may = (comps != a_own) & (100 * np.minimum(sizes, a_n) >= near.percent * np.maximum(sizes, a_n))
                    wanted = graph.wanted(a_own, places)
                    cut |= bool((may & ~wanted).any())
                    at = np.flatnonzero(may & wanted)
                    if not len(at):
                        continue
                    differ = differing_bits(maps[at], a_bits)
                    may = (100 + near.percent) * differ <= (100 - near.percent) * (sizes[at] + a_n)
                    if len(known):
                        may &= ~np.isin(theirs[at], known)
                    at, differ = at[may], differ[may]
                    may = share_a_key(keys[at], a_hashes)
                    at, differ = at[may], differ[may]
                    order = np.lexsort((theirs[at], differ))
                    order = order[np.sort(_first_of_each(places[at[order]], forests))]
                    taken = order[graph.add(a_own, places[at[order]])]
                    cut |= len(taken) < len(at)
                    for k in taken:
                        found.append((int(key[start]), a_own, int(comps[at[k]]), int(differ[k]), a, int(theirs[at[k]])))
                if cut:
                    found.append((int(key[start]), None, None, None, None, None))
            yield _pairs_found(found)
            found = []

    with arrow_rows(mixed.sparkSession, 2_000):
        return staged(rows.mapInArrow(run, "key long, one long, two long, differ long, a long, b long"), "nearest")


def _of_components(given: DataFrame, most: int) -> DataFrame:
    """(a, b, one, two): of two components the ``most`` pairs whose bitmaps differ least."""
    pairs = given.select(F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two"),
                         F.struct("differ", "a", "b").alias("x")).groupBy("one", "two")
    if most == 1:
        pairs = pairs.agg(F.min("x").alias("x"))
    else:
        pairs = pairs.agg(F.array_sort(F.collect_set("x")).alias("xs")).select("one", "two", F.explode(F.slice("xs", 1, most)).alias("x"))
    return pairs.select("x.a", "x.b", "one", "two")


class Forests:
    """``n`` forests without a common edge, of a graph whose edges come one star at a time:
    an edge goes into the first forest in which it closes no circle. What no forest takes
    joins vertices that each of them connects."""

    def __init__(self, n: int) -> None:
        self.at: dict[int, int] = {}
        self.trees = [np.zeros(0, dtype=np.int64)] * n  # by place: a place that names its tree; none is changed while empty

    def places(self, vertices: np.ndarray) -> np.ndarray:
        names, which = np.unique(vertices, return_inverse=True)
        return np.array([self._place(x) for x in names.tolist()], dtype=np.int64)[which]

    def _place(self, vertex: int) -> int:
        return self.at.setdefault(vertex, len(self.at))

    def _tree(self, i: int) -> np.ndarray:
        tree = self.trees[i]
        if len(tree) < len(self.at):
            tree = self.trees[i] = np.r_[tree, np.arange(len(tree), len(self.at))]
        return tree

    def wanted(self, centre: int, places: np.ndarray) -> np.ndarray:
        """Which ends the last forest does not connect with the centre; other edges no
        forest would take."""
        centre, tree = self._place(centre), self._tree(len(self.trees) - 1)
        return tree[places] != tree[centre]

    def add(self, centre: int, places: np.ndarray) -> np.ndarray:
        """Numbers of the edges from ``centre`` to ``places`` that a forest takes, those
        that come first before others."""
        centre, left, taken = self._place(centre), np.arange(len(places)), []
        for i in range(len(self.trees)):
            if not len(left):
                break
            tree = self._tree(i)
            ends = tree[places[left]]
            first = np.unique(ends, return_index=True)[1]
            first = first[ends[first] != tree[centre]]
            taken.append(left[first])
            tree[np.isin(tree, ends[first])] = tree[centre]
            left = np.delete(left, first)
        return np.sort(np.concatenate(taken)) if taken else np.zeros(0, dtype=np.int64)


def _first_of_each(values: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of each value."""
    by = np.argsort(values, kind="stable")
    starts = np.flatnonzero(np.r_[True, values[by][1:] != values[by][:-1]])
    rank = np.arange(len(by)) - np.repeat(starts, np.diff(np.r_[starts, len(by)]))
    return by[rank < n]


def _pairs_found(rows: list[tuple]) -> pa.RecordBatch:
    names = ["key", "one", "two", "differ", "a", "b"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(6)], names)
