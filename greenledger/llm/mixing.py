"""Mixing sources to target weights by Pfair scheduling.

A source of weight w out of a cycle of H slots gives its i-th block the release
time floor(i H / w) and the deadline ceil((i + 1) H / w). In every slot the
released block of the earliest deadline is taken. Up to any slot each source has
then had its weight's share of blocks to within less than one block. The cycle is
FINE times the whole run, so that rounding the targets to whole shares moves no
source by more than 1 / FINE of a block. One task walks the slots, holding one
block of each source; each document finds its slot from its number within its
source.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, prepare, staged, unused

#: Documents of a block, and slots of a cycle at least.
BLOCK, CYCLE = 8, 1000

#: Slots of a cycle for each slot of the run.
FINE = 1000

#: Sources that may be mixed; their counts and shares are held by the driver.
MOST_SOURCES = 100_000


def whole_shares(weights: Mapping[str, float], cycle: int) -> dict[str, int]:
    """Slots of each source in a cycle: by largest remainder, one at least."""
    cycle = max(cycle, len(weights))
    if not weights or min(weights.values()) < 0 or sum(weights.values()) <= 0:
        raise ValueError("weights must not be negative and one must be positive")
    each = cycle / sum(map(Fraction, weights.values()))
    exact = {s: each * Fraction(w) for s, w in weights.items()}
    shares = {s: max(1, int(x)) for s, x in exact.items()}
    behind = [(shares[s] - x, s) for s, x in exact.items()]
    more = cycle - sum(shares.values())
    if more > 0:
        for _, s in heapq.nsmallest(more, behind):
            shares[s] += 1
    elif more < 0:  # sources below one slot were given one: the others give it, those most ahead first
        ahead = [(-x, s) for x, s in behind if shares[s] > 1]
        heapq.heapify(ahead)
        for _ in range(-more):
            x, s = heapq.heappop(ahead)
            shares[s] -= 1
            if shares[s] > 1:
                heapq.heappush(ahead, (x + 1, s))
    return shares


def run_shares(weights: Mapping[str, float], blocks: Mapping[str, int], cycle: int) -> dict[str, int]:
    """Whole shares that stay at the targets to 1 / FINE of a block until each
    source has had all its blocks. Sources of weight 0 share one slot in ``cycle``."""
    total = sum(map(Fraction, weights.values()))
    none = sum(not w for w in weights.values())
    exact = {s: Fraction(w) or Fraction(total, cycle * none) for s, w in weights.items()}
    whole = sum(exact.values())
    slots = max((-(-blocks[s] * whole // w) for s, w in exact.items() if w), default=0)
    if slots * FINE >= 1 << 55:
        raise ValueError("the least weight is too small: slots are beyond a long")
    return whole_shares(exact, max(cycle, slots * FINE))


def walk(shares: Mapping[str, int], blocks: Mapping[str, int]) -> Iterator[tuple[int, str, int]]:
    """(slot, source, block) of all blocks: earliest deadline first. A source that has run
    out leaves; the others keep their release times and deadlines, which they meet all
    the more. Slots in which no block is released yet are passed over at once, so the walk
    takes a step for each block, whatever the weights are."""
    cycle = sum(shares.values())
    waiting = [(0, s, 0) for s in sorted(shares) if shares[s] and blocks[s]]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []  # deadline, source, block
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * cycle // shares[s]), s, i))
        _, s, i = heapq.heappop(ready)
        yield slot, s, i
        if i + 1 < blocks[s]:
            heapq.heappush(waiting, ((i + 1) * cycle // shares[s], s, i + 1))
        slot += 1


def schedule(shares: Mapping[str, int]) -> list[str]:
    """The source of each slot of one cycle: earliest deadline first."""
    return [s for _, s, _ in walk(shares, shares)]


def numbered(docs: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, name, n): rows of each source numbered from 0 in the order
    of a hash of their id. Ranges of rows are numbered by themselves and then
    offset by the counts before them, so no task needs a whole source."""
    prepare(docs.sparkSession)
    source = docs[source_col].cast("string")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), source.alias("source"),
                       F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("name"))  # null is a source too
    rows = rows.withColumn("h", F.xxhash64(F.col("doc_id")))
    rows = rows.repartitionByRange("name", "h", "doc_id").sortWithinPartitions("name", "h", "doc_id")

    def run(batches):
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            at = []
            for name in batch.column(2).to_pylist():
                n = n + 1 if name == last else 0
                last = name
                at.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([part] * len(at), pa.int32()), pa.array(at, pa.int64())],
                ["doc_id", "source", "name", "part", "at"])

    with arrow_rows(docs.sparkSession, 20_000):
        local = staged(rows.mapInArrow(run, "doc_id long, source string, name string, part int, at long"), "numbered")
    counts = local.groupBy("name", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("name", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    return local.join(counts, ["name", "part"]).select("doc_id", "source", "name", (F.col("before") + F.col("at")).alias("n"))


def mix_sources(docs: DataFrame, weights: Mapping[str | None, float] | None = None, *, id_col: str = "doc_id",
                source_col: str = "source", block: int = BLOCK, cycle: int = CYCLE, power: float = 0.5) -> DataFrame:
    """(doc_id, source, block, slot, place, share) of every row; ``place`` orders the mix.

    ``weights`` gives each source its target; sources that it does not name, or
    names with 0, share one slot a ``cycle``. Without it the target is the source's
    number of rows to the ``power``. ``share`` is the target in whole slots of the
    run's cycle, which is as long as rounding to less than 1 / FINE of a block over
    the run takes, and ``cycle`` slots at least. Every row has a place: a source
    that has run out leaves the mix and the others go on at their targets, so that a slot
    in which none of them is due stays empty. A null source is a source of its own; repeated rows and ids are
    rows of their own; other columns are ignored; an empty table gives an empty
    result."""
    spark = docs.sparkSession
    rows = numbered(docs, id_col, source_col)
    sizes = {r["name"]: r["n"] for r in rows.groupBy("name").agg(F.max("n").alias("n")).limit(MOST_SOURCES + 1).collect()}
    if len(sizes) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    if weights is None:
        target = {s: (n + 1) ** power for s, n in sizes.items()}
    else:
        named = {"" if s is None else f"={s}": w for s, w in weights.items()}
        target = {s: named.get(s, 0.0) for s in sizes}
    blocks = {s: n // block + 1 for s, n in sizes.items()}
    shares = run_shares(target, blocks, cycle) if target else {}

    def slots(batches):
        for batch in batches:
            found = walk(shares, blocks) if batch.num_rows else iter(())
            while some := list(islice(found, 20_000)):
                at, names, turns = zip(*some, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(turns, pa.int64()), pa.array(at, pa.int64()),
                     pa.array([shares[s] for s in names], pa.int64())], ["name", "block", "slot", "share"])

    table = staged(spark.range(0, 1, 1, 1).mapInArrow(slots, "name string, block long, slot long, share long"), "slots")
    rows = rows.withColumn("block", F.floor(F.col("n") / block).cast("long"))
    return (rows.join(table, ["name", "block"])
            .select("doc_id", "source", "block", "slot", (F.col("slot") * block + F.col("n") % block).alias("place"), "share"))


def in_order(docs: DataFrame, weights: Mapping[str | None, float] | None = None, *, id_col: str = "doc_id",
             source_col: str = "source", **options) -> DataFrame:
    """All rows and columns of ``docs``, in ranges of the mix's places and sorted by
    them, so that what is written is read in the mix's order. Rows that share an
    id stand together at its first place; rows with a null id come first."""
    mixed = mix_sources(docs, weights, id_col=id_col, source_col=source_col, **options)
    key, place = unused(docs, "_id"), unused(docs, "_place")
    places = mixed.groupBy(F.col("doc_id").alias(key)).agg(F.min("place").alias(place))
    rows = docs.join(places, docs[id_col].cast("long") == places[key], "left")
    return rows.repartitionByRange(place).sortWithinPartitions(place).select(*docs.columns)
