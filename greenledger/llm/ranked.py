"""Positions and running sums within groups, without a task that holds a group."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from .common import arrow_rows, prepare, staged


def running(rows: DataFrame, group: str, order: Sequence[str | Column], weight: str | None = None) -> DataFrame:
    """``rows`` with their position ``n`` in their group from 0, the sum ``before``
    of the weights ahead of them there, and the group's ``rows`` and ``total``.

    Ranges of (group, order) are sorted and numbered by themselves, then offset by
    what stands before them, so a group of any size spans many tasks. ``group`` must
    not be null and weights are whole numbers; without ``weight`` each row weighs 1."""
    prepare(rows.sparkSession)
    names = rows.columns
    at_group, at_weight = names.index(group), names.index(weight) if weight else None
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    schema = StructType(rows.schema.fields).add("_part", IntegerType()).add("_n", LongType()).add("_before", LongType())

    def run(batches):
        part, last, n, total = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            code = batch.column(at_group).dictionary_encode().indices.to_numpy()
            new = np.r_[last is None or batch.column(at_group)[0].as_py() != last, code[1:] != code[:-1]]
            w = np.ones(size, np.int64) if at_weight is None else batch.column(at_weight).to_numpy()
            index = np.arange(size)
            start = np.maximum.accumulate(np.where(new, index, -1))
            ahead = np.cumsum(w) - w
            begun = start >= 0
            position = np.where(begun, index - start, index + n)
            before = ahead - np.where(begun, ahead[np.maximum(start, 0)], -total)
            last, n, total = batch.column(at_group)[-1].as_py(), int(position[-1]) + 1, int(before[-1] + w[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(size, part, np.int32)), pa.array(position), pa.array(before)],
                [*names, "_part", "_n", "_before"])

    with arrow_rows(rows.sparkSession, 10_000):
        local = staged(ranged.mapInArrow(run, schema), "ranked")
    sums = local.groupBy(group, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(weight or F.lit(1)).alias("_sum"))
    whole = Window.partitionBy(group)
    ahead = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "_part", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_rows_ahead"),
                       F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_sum_ahead"),
                       F.sum("_rows").over(whole).alias("rows"), F.sum("_sum").over(whole).alias("total"))
    return local.join(sums, [group, "_part"]).select(
        *names, (F.col("_n") + F.col("_rows_ahead")).alias("n"), (F.col("_before") + F.col("_sum_ahead")).alias("before"),
        "rows", "total")
