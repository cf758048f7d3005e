"""Merkle manifest of a dataset as a postorder append log.

Each tree's leaves are dealt to aligned builders: a builder takes the leaves of
one complete subtree of a few levels and appends each node when its last child is
there, which is postorder. Where a node stands in its tree's log follows from the
sizes of complete subtrees alone, so builders write without knowing one another,
and a proof finds the siblings of a leaf at positions that are computed, not
searched. The roots of the builders' subtrees are the leaves of the next round;
a round has ``fanout ** levels`` times fewer nodes than the one before.

Proofs go the other way: a builder's nodes, the path above its root and the leaves
asked for meet in one task, which holds the nodes of one builder.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, prepare, staged
from .ranked import running


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@dataclass(frozen=True)
class Shape:
    """Nodes of a run, and levels that one builder adds: 256 leaves each."""

    fanout: int = 16
    levels: int = 2

    def width(self, leaves: int, level: int) -> int:
        """Nodes of a level; the last run of a level may be shorter."""
        return -(-leaves // self.fanout ** level)

    def height(self, leaves: int) -> int:
        level = 0
        while self.width(leaves, level) > 1:
            level += 1
        return level

    def position(self, leaves: int, level: int, i: int) -> int:
        """Place of node i of a level in the tree's postorder log: all nodes at or
        below its level up to its last descendant, and those above that were
        complete before its first leaf."""
        f = self.fanout
        below = sum(min((i + 1) * f ** (level - k), self.width(leaves, k)) for k in range(level + 1))
        above = 0
        while (i := i // f) > 0:
            above += i
        return below + above - 1

    def segment(self, i: int) -> int:
        return i // self.fanout ** self.levels


def field(value: Column) -> Column:
    """A value as a leaf holds it: ``-`` for null, else its UTF-8 bytes' number, a
    colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


NODE = "tree string, leaves long, position long, level int, i long, digest string, top boolean"


def _builders(nodes: DataFrame, base: int, shape: Shape) -> DataFrame:
    """The log of one round (columns of NODE): ``nodes`` (tree, leaves, i, digest) of
    level ``base``, each followed by what it completes."""
    per = shape.fanout ** shape.levels
    rows = nodes.select("tree", F.floor(F.col("i") / per).alias("segment"), "i", "leaves", "digest")
    rows = rows.repartition("tree", "segment").sortWithinPartitions("tree", "i")

    def run(batches):
        runs: list[list[str]] = []  # the open run of each level, from base on
        for batch in batches:
            out = []
            for tree, _, i, leaves, node in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if i % per == 0:
                    runs = [[] for _ in range(shape.levels)]
                level, top = base, shape.width(leaves, base) == 1
                if base == 0:
                    out.append((tree, leaves, shape.position(leaves, 0, i), 0, i, node, top))
                while not top and level < base + shape.levels:
                    run = runs[level - base]
                    run.append(node)
                    if (i + 1) % shape.fanout and i + 1 < shape.width(leaves, level):
                        break
                    node, i, level = digest(*run), i // shape.fanout, level + 1
                    run.clear()
                    top = shape.width(leaves, level) == 1
                    out.append((tree, leaves, shape.position(leaves, level, i), level, i, node, top))
            columns = zip(*out, strict=True) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, _NODE_TYPES, strict=True)], _NODE_NAMES)

    return rows.mapInArrow(run, NODE)


_NODE_NAMES = ["tree", "leaves", "position", "level", "i", "digest", "top"]
_NODE_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_()]


def append_log(leaves: DataFrame, shape: Shape = Shape()) -> list[DataFrame]:
    """The postorder log of every tree, one written table a round. ``leaves`` has
    (tree, leaves, i, digest), with the number of its tree's leaves in every row."""
    prepare(leaves.sparkSession)
    most = leaves.agg(F.max("leaves")).first()[0] or 0
    rounds, nodes, base = [], leaves, 0
    with arrow_rows(leaves.sparkSession, 10_000):
        while not rounds or shape.width(most, base) > 1:
            rounds.append(staged(_builders(nodes, base, shape), "merkle-log"))
            base += shape.levels
            nodes = rounds[-1].filter((F.col("level") == base) & ~F.col("top"))
    return rounds


def subroots(rounds: Sequence[DataFrame]) -> DataFrame:
    """(tree, size, digest) of each tree: its leaves' number and its last node."""
    tops = [r.filter("top").select("tree", F.col("leaves").alias("size"), "digest") for r in rounds]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


def _met(round_: DataFrame, below: DataFrame | None, above: DataFrame, asked: DataFrame, base: int,
         shape: Shape) -> DataFrame:
    """Rows of one round by builder: the path above its root (kind 0, with the tree's
    ``subroot``), its nodes (1), and what is asked for (2, with ``i``, ``key``, ``leaf``
    and ``start``, the digest to fold)."""
    per = shape.fanout ** shape.levels

    def part(rows: DataFrame, kind: int, segment: Column, **have) -> DataFrame:
        null = {"leaves": F.lit(None).cast("long"), "place": F.lit(None).cast("long"), "digest": F.lit(None).cast("string"),
                "key": F.lit(None).cast("long"), "leaf": F.lit(None).cast("string"),
                "path": F.lit(None).cast("array<string>")}
        return rows.select("tree", segment.cast("long").alias("segment"), F.lit(kind).alias("kind"),
                           *[c.alias(name) for name, c in (null | have).items()])

    own = F.floor(F.col("i") / F.lit(shape.fanout) ** (F.lit(base + shape.levels) - F.col("level")))
    nodes = part(round_, 1, own, leaves=F.col("leaves"), place=F.col("position"), digest=F.col("digest"))
    if below is not None:  # the leaves of this round stand in the log of the one before
        inner = below.filter((F.col("level") == base) & ~F.col("top"))
        nodes = nodes.unionByName(part(inner, 1, F.floor(F.col("i") / per), leaves=F.col("leaves"),
                                       place=F.col("position"), digest=F.col("digest")))
    rows = (part(above, 0, F.col("segment"), digest=F.col("subroot"), path=F.col("path")).unionByName(nodes)
            .unionByName(part(asked, 2, F.floor(F.col("i") / per), place=F.col("i"), digest=F.col("start"),
                              key=F.col("key"), leaf=F.col("leaf"))))
    return rows.repartition("tree", "segment").sortWithinPartitions("tree", "segment", "kind", "place")


def _paths(batches, base: int, shape: Shape) -> Iterator[list[tuple]]:
    """(tree, i, key, leaf, start, subroot, path) of what is asked for, a batch at a
    time. A path has two strings a level: the digests of the run before the node,
    and after it."""
    f, own, log, runs = shape.fanout, None, {}, {}
    leaves, upper, subroot = 0, [], None

    def siblings(level: int, i: int) -> tuple[str, str]:
        first = i - i % f
        if (level, first) not in runs:
            last = min(first + f, shape.width(leaves, level))
            runs[level, first] = [log[shape.position(leaves, level, k)] for k in range(first, last)]
        run = runs[level, first]
        return "".join(run[:i - first]), "".join(run[i - first + 1:])

    for batch in batches:
        out = []
        for tree, segment, kind, n, place, node, key, leaf, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != (tree, segment):
                own, log, runs, upper = (tree, segment), {}, {}, []
            if kind == 0:
                upper, subroot = path, node
            elif kind == 1:
                leaves, log[place] = n, node
            else:
                found, i = [], place
                for level in range(base, base + shape.levels):
                    if shape.width(leaves, level) == 1:
                        break
                    found += siblings(level, i)
                    i //= f
                out.append((tree, place, key, leaf, node, subroot, found + upper))
        yield out


def _climb(rounds: Sequence[DataFrame], tops: DataFrame, shape: Shape) -> DataFrame:
    """(tree, segment, subroot, path): the path above the root of every builder of the
    first round. ``tops`` (tree, size, subroot, path) has the path above each tree's root."""
    done: DataFrame | None = None
    for k in reversed(range(len(rounds))):
        low, high = (F.lit(shape.fanout ** (n * shape.levels)) for n in (k, k + 1))
        ends = tops.filter((F.col("size") <= high) & ((F.col("size") > low) | F.lit(not k))).select(
            "tree", F.lit(0).cast("long").alias("segment"), "subroot", "path")
        above = ends if done is None else ends.unionByName(done)
        if not k:
            return above
        base = k * shape.levels
        inner = rounds[k - 1].filter((F.col("level") == base) & ~F.col("top")).select(
            "tree", "i", *_nothing())

        def run(batches, base=base):
            for found in _paths(batches, base, shape):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64()),
                     pa.array([x[5] for x in found], pa.string()), pa.array([x[6] for x in found], pa.list_(pa.string()))],
                    ["tree", "segment", "subroot", "path"])

        met = _met(rounds[k], rounds[k - 1], above, inner, base, shape)
        done = staged(met.mapInArrow(run, "tree string, segment long, subroot string, path array<string>"), "merkle-paths")
    raise ValueError("no rounds")


def _nothing() -> list[Column]:
    none = F.lit(None)
    return [none.cast("long").alias("key"), none.cast("string").alias("leaf"), none.cast("string").alias("start")]


@dataclass(frozen=True)
class Manifest:
    """The numbered leaves (``tree`` names the source), the logs of the sources'
    trees and of the tree over their roots, round by round, and its root."""

    leaves: DataFrame
    rounds: list[DataFrame]
    top_rounds: list[DataFrame]
    names: DataFrame
    root: str | None
    shape: Shape

    def proofs(self, asked: DataFrame) -> DataFrame:
        """(tree, i, key, leaf, subroot, proof_sha256, folded_root) for ``asked`` (tree, i,
        key, leaf, start): the digest of the siblings on the way from leaf i to the
        root, and the root that follows from them and the digest ``start``."""
        shape = self.shape
        whole = F.lit("").alias("tree")
        bare = self.names.limit(1).select(whole, F.col("leaves").alias("size"), F.lit(None).cast("string").alias("subroot"),
                                          F.array().cast("array<string>").alias("path"))
        entries = self.names.select(whole, "i", *_nothing())

        def climbed(batches):
            for found in _paths(batches, 0, shape):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[1] for x in found], pa.int64()), pa.array([x[6] for x in found], pa.list_(pa.string()))],
                    ["i", "path"])

        met = _met(self.top_rounds[0], None, _climb(self.top_rounds, bare, shape), entries, 0, shape)
        above = met.mapInArrow(climbed, "i long, path array<string>")
        tops = staged(above.join(self.names, "i").select("tree", "size", F.col("digest").alias("subroot"), "path"), "merkle-tops")

        def fold(batches):
            for found in _paths(batches, 0, shape):
                out = []
                for tree, i, key, leaf, node, subroot, path in found:
                    for k in range(0, len(path), 2):
                        node = digest(path[k], node, path[k + 1])
                    out.append((tree, i, key, leaf, subroot, digest(*path), node))
                columns = zip(*out, strict=True) if out else [[]] * 7
                kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names)

        names = ["tree", "i", "key", "leaf", "subroot", "proof_sha256", "folded_root"]
        return _met(self.rounds[0], None, _climb(self.rounds, tops, shape), asked, 0, shape).mapInArrow(
            fold, "tree string, i long, key long, leaf string, subroot string, proof_sha256 string, folded_root string")


def manifest(leaves: DataFrame, shape: Shape = Shape()) -> Manifest:
    """The manifest of ``leaves`` (tree, doc_id, leaf, and more columns): in each tree
    they ascend by doc_id, nulls first, equal ids by digest; the trees' roots are
    ordered by the trees' names, bytewise. ``tree`` must not be null."""
    tied = staged(leaves.withColumn("_tie", F.monotonically_increasing_id()), "merkle-leaves")
    numbered = running(tied, "tree", ["doc_id", "leaf", "_tie"]).withColumnsRenamed({"n": "i", "rows": "leaves"})
    numbered = staged(numbered.drop("_tie", "before", "total"), "merkle-numbered")
    rounds = append_log(numbered.select("tree", "leaves", "i", F.col("leaf").alias("digest")), shape)
    names = running(subroots(rounds).withColumn("_all", F.lit(0)), "_all", ["tree"])
    names = staged(names.select("tree", "size", "digest", F.col("n").alias("i"), F.col("rows").alias("leaves")), "merkle-subroots")
    top_rounds = append_log(names.select(F.lit("").alias("tree"), "leaves", "i", "digest"), shape)
    root = subroots(top_rounds).first()
    return Manifest(numbered, rounds, top_rounds, names, root["digest"] if root else None, shape)


def document_proofs(docs: DataFrame, shape: Shape = Shape(), *, every: int = 5) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per
    input row, with documents tampered with where ``every`` divides the crc32 of the
    decimal id: their text's A-Z are lower-cased before folding.

    Any field may be null and counts as ``-``; a null id comes first in its source
    and is never tampered with; a null source is a source of its own and comes first.
    Repeated rows are leaves of their own; equal ids are ordered by their leaf.
    Other columns are ignored; an empty table gives an empty result."""
    text = docs["text"].cast("string")
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    chosen = F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % every == 0, F.lit(False))
    fields = [docs[c] for c in ("doc_id", "source", "lang", "n_chars")]
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), docs["source"].cast("string")), F.lit("")).alias("tree"),
        docs["doc_id"].cast("long").alias("doc_id"), leaf_digest([*fields, text]).alias("leaf"),
        F.when(chosen, leaf_digest([*fields, lowered])).alias("forged"))
    made = manifest(rows, shape)
    asked = made.leaves.select("tree", "i", F.col("doc_id").alias("key"), "leaf", F.coalesce("forged", "leaf").alias("start"))
    root = F.lit(made.root)
    return made.proofs(asked).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"))
