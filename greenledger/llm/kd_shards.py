"""Sharding by a k-d tree over metadata.

A node of the tree is a set of documents and the number of shards that it is to
become. Nodes are cut at the weighted median, the place where the bytes ahead are
in proportion to the shards that go left, along the dimension in which the node
is widest, until each node is one shard. All nodes of a level are cut in one pass:
ranges of (node, coordinates) are sorted, summed up and offset by what stands
before them, so a node of any size and a value that many documents share span many
tasks, and equal values are cut by the other dimensions, the id and the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .common import attach, prepare, staged
from .ranked import running

#: Bytes of a text value that place it on its axis.
AXIS_BYTES = 6


def coordinate(docs: DataFrame, name: str) -> Column:
    """A metadata value as a number: a text by its first bytes, in their order. A null
    stands at the lower end."""
    if isinstance(docs.schema[name].dataType, NumericType):
        return docs[name].cast("double")
    head = F.substring(F.encode(docs[name].cast("string"), "UTF-8"), 1, AXIS_BYTES)
    return F.conv(F.rpad(F.hex(head), 2 * AXIS_BYTES, "0"), 16, 10).cast("double")


def document_sizes(docs: DataFrame, id_col: str, text_col: str, dimensions: Sequence[str]) -> DataFrame:
    """(doc_id, size, text_crc32, tie, x0, x1, ..): bytes of the text and 1, the crc32
    of these bytes, and each dimension scaled to 0..1 over all documents."""
    data = F.encode(F.coalesce(docs[text_col].cast("string"), F.lit("")), "UTF-8")
    rows = staged(docs.select(
        docs[id_col].cast("long").alias("doc_id"), (F.length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), F.monotonically_increasing_id().alias("tie"),
        *[coordinate(docs, name).alias(f"x{k}") for k, name in enumerate(dimensions)]), "shard-sizes")
    axes = [f"x{k}" for k in range(len(dimensions))]
    ends = rows.agg(*[f(a).alias(f"{f.__name__}_{a}") for a in axes for f in (F.min, F.max)]).first()

    def scaled(a: str) -> Column:
        low, high = ends[f"min_{a}"], ends[f"max_{a}"]
        if low is None or low == high:
            return F.lit(0.0)
        return F.coalesce((F.col(a) - F.lit(low)) / F.lit(high - low), F.lit(0.0))

    return rows.select("doc_id", "size", "text_crc32", "tie", *[scaled(a).alias(a) for a in axes])


def kd_shards(docs: DataFrame, shards: int | None = None, *, target_bytes: int | None = None, id_col: str = "doc_id",
              text_col: str = "text", dimensions: Sequence[str] = ("source", "lang", "n_chars")) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), one row per input row.

    Give the number of ``shards``, or ``target_bytes``, from which it follows. Shards
    are numbered from left to right in the tree; their bytes differ from the mean
    by one document's at most a cut. Slots number a shard's rows from 0 by id. A
    null text has no bytes and the crc32 of none; null metadata stands at the lower
    end of its axis; null ids come first; repeated rows are rows of their own, a text
    longer than a shard is a shard's only large one; other columns are ignored; an
    empty table gives an empty result, fewer rows than shards leave shards empty."""
    if (shards is None) == (target_bytes is None):
        raise ValueError("give the number of shards or the bytes of one")
    prepare(docs.sparkSession)
    rows = document_sizes(docs, id_col, text_col, dimensions)
    if shards is None:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    axes = [f"x{k}" for k in range(len(dimensions))]
    rows = rows.withColumns({"shard": F.lit(0), "leaves": F.lit(int(shards))})
    most = shards
    while most > 1:
        rows = staged(_cut(rows, axes), "shard-cut")
        most = -(-most // 2)
    numbered = running(rows.select("doc_id", "size", "text_crc32", "tie", "shard"), "shard", ["doc_id", "tie"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", F.col("n").alias("slot"))


def _cut(rows: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Each node (``shard``, its first one, and ``leaves``) cut in two, or left alone if
    it is a single shard."""
    widest = F.greatest(*[F.max(a) - F.min(a) for a in axes], F.lit(-1.0))
    axis = F.coalesce(*[F.when(F.max(a) - F.min(a) == widest, F.lit(k)) for k, a in enumerate(axes)], F.lit(0))
    nodes = rows.groupBy("shard").agg(axis.alias("axis"))
    along = F.coalesce(*[F.when(F.col("axis") == k, F.col(a)) for k, a in enumerate(axes)], F.lit(0.0))
    placed = attach(rows, nodes, ["shard"], "tie").withColumn("along", along).drop("axis")
    left = F.floor(F.col("leaves") / 2).cast("int")
    summed = running(placed, "shard", ["along", *axes, "doc_id", "tie"], "size")
    beyond = (F.lit(2.0) * F.col("before") + F.col("size")) * F.col("leaves") > F.lit(2.0) * F.col("total") * left
    return summed.select(
        "doc_id", "size", "text_crc32", "tie", *axes, (F.col("shard") + F.when(beyond, left).otherwise(0)).alias("shard"),
        F.when(beyond, F.col("leaves") - left).otherwise(left).alias("leaves"))


def write_shards(docs: DataFrame, path: str, shards: int | None = None, *, id_col: str = "doc_id",
                 folder_col: str = "_shard", **options) -> DataFrame:
    """Write all rows and columns of ``docs`` as Parquet into one folder a shard below
    ``path`` (``_shard=0``, ..), each sorted by slot, and return the assignment. Rows
    that share an id go to the first shard and slot of these, rows without one to
    that of the first null. A column named like ``folder_col`` is an error."""
    if folder_col in docs.columns:
        raise ValueError(f"documents have a column {folder_col}; name another folder_col")
    placed = staged(kd_shards(docs, shards, id_col=id_col, **options), "shards")
    keys = ["_id", "_null"]

    def keyed(name: str) -> list[Column]:
        return [F.coalesce(F.col(name).cast("long"), F.lit(0)).alias("_id"), F.col(name).isNull().alias("_null")]

    first = placed.groupBy(*keyed("doc_id")).agg(F.min(F.struct("shard", "slot")).alias("first"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *keyed(id_col),
                       F.monotonically_increasing_id().alias("_spread"))
    rows = attach(rows, first, keys, "_spread").select("row", "first", "_spread")
    order = ["first.shard", "first.slot", "_spread"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.select("row.*", F.col("first.shard").alias(folder_col)).write.partitionBy(folder_col).parquet(path)
    return placed
