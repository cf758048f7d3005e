"""Dense integer surrogate keys without a single-partition window.

``row_number() OVER (ORDER BY ...)`` funnels every row through one task.
Here the rows are range-partitioned and sorted in parallel and written to
the shared folder with their partition and position, so both are fixed
whatever happens to an executor. The row counts of the partitions (one
number each) give each partition its first key. Keys are 1..N, dense, and
follow the requested order, ascending with NULLs last.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def dense_key(df: DataFrame, order: Sequence[str], key_name: str,
              partitions: int | None = None) -> DataFrame:
    """Add ``key_name`` (int, 1..N) numbering rows by ``order``; the other
    columns, in frame order, break ties so keys are deterministic."""
    spark = df.sparkSession
    ties = [c for c in df.columns if c not in order]
    by = [F.col(c).asc_nulls_last() for c in [*order, *ties]]
    ranged = (df.repartitionByRange(partitions, *by) if partitions
              else df.repartitionByRange(*by)).sortWithinPartitions(*by)
    pid = F.spark_partition_id()
    position = F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)
    placed = written(ranged.select("*", pid.alias("_pid"), position.alias("_pos")), "dense-key")
    sizes = sorted((r["_pid"], r["n"]) for r in
                   placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    starts = [0, *accumulate(n for _, n in sizes)]
    first = spark.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)],
                                  "_pid int, _first bigint")  # one row a partition
    key = (F.col("_first") + F.col("_pos") + 1).cast("int").alias(key_name)
    return placed.join(first, "_pid").select(key, *df.columns)
