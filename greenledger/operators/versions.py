"""Validity-dated versions: conflicts between them, what they cover, and which one holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .facts import OPEN_END

# What can be between two versions of a key.
OVERLAP, HOLE, REVERSED = "OVERLAP", "HOLE", "REVERSED"


def _spans(versions: DataFrame, key: str, valid_from: str, valid_to: str, month: bool) -> DataFrame:
    lo = F.col(valid_from).cast("date")
    hi = F.coalesce(F.col(valid_to).cast("date"), F.lit(OPEN_END).cast("date"))
    if month:
        lo, hi = F.trunc(lo, "month"), F.last_day(hi)
    return versions.select(F.col(key).alias("key"), lo.alias("lo"), hi.alias("hi")).where("key IS NOT NULL AND lo IS NOT NULL")


def _reach(spans: DataFrame) -> DataFrame:
    """Each span with the last day that any earlier one of its key reaches."""
    before = Window.partitionBy("key").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("reach", F.max("hi").over(before))


def version_conflicts(versions: DataFrame, key: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
                      month: bool = False) -> DataFrame:
    """(key, kind, first_day, last_day, days) of every overlap of a version with those before
    it, of every hole between versions, and of versions that end before they begin.

    One sweep per key, in the order of the first days, with a running maximum of the last
    days, so that a long version is not forgotten behind a short one. With ``month``
    versions hold for whole months, as the monthly fact takes them. Versions without a key
    or a first day are in no sweep; an open end reaches for good."""
    spans = _spans(versions, key, valid_from, valid_to, month)
    swept = _reach(spans.where("lo <= hi"))
    kind = F.when(F.col("lo") <= F.col("reach"), F.lit(OVERLAP)).when(F.col("lo") > F.date_add("reach", 1), F.lit(HOLE))
    found = swept.withColumn("kind", kind).where("kind IS NOT NULL").select(
        "key", "kind", F.when(F.col("kind") == OVERLAP, F.col("lo")).otherwise(F.date_add("reach", 1)).alias("first_day"),
        F.when(F.col("kind") == OVERLAP, F.least("reach", "hi")).otherwise(F.date_sub("lo", 1)).alias("last_day"))
    turned = spans.where("lo > hi").select("key", F.lit(REVERSED).alias("kind"), F.col("lo").alias("first_day"), F.col("hi").alias("last_day"))
    days = (F.datediff("last_day", "first_day") + 1).alias("days")
    return found.unionByName(turned).select("key", "kind", "first_day", "last_day", days)


def covered_spans(versions: DataFrame, key: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """(key, first_day, last_day, versions): the stretches that a key's versions cover without
    a hole, overlapping and adjoining ones joined; ``last_day`` is null where one is open."""
    swept = _reach(_spans(versions, key, valid_from, valid_to, False).where("lo <= hi"))
    new = F.coalesce((F.col("lo") > F.date_add("reach", 1)).cast("int"), F.lit(1))
    upto = Window.partitionBy("key").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, 0)
    joined = swept.withColumn("stretch", F.sum(new).over(upto)).groupBy("key", "stretch").agg(
        F.min("lo").alias("first_day"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("versions"))
    return joined.select("key", "first_day", F.when(F.col("hi") < F.lit(OPEN_END).cast("date"), F.col("hi")).alias("last_day"), "versions")


def as_of(asked: DataFrame, versions: DataFrame, key: str, at: str, since: str, payload: str) -> DataFrame:
    """``asked`` with the ``payload`` and the ``since`` of the latest version of its key that began
    at or before ``at``; null where there is none. Of versions that began at once the
    greatest payload holds.

    Versions need no end. Both sides are sorted together in ranges of (key, time), so a key
    of any size spans many tasks; within a range the last version is carried forward,
    and into a range comes the last one of the ranges before it, of which there is one a
    key and range. ``asked`` keeps its rows, those with a null key or time too."""
    from pyspark.sql.types import StructField, StructType

    fields = asked.columns
    have = F.struct(F.col(since).alias("since"), F.col(payload).alias("payload"))
    none = F.lit(None).cast(versions.select(have.alias("h")).schema["h"].dataType)
    row_type = StructType([StructField(f.name, f.dataType, True) for f in asked.schema.fields])
    probes = asked.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"), none.alias("_have"),
                          F.struct(*fields).alias("_row"))
    known = versions.where(F.col(key).isNotNull() & F.col(since).isNotNull()).select(
        F.col(key).alias("_key"), F.col(since).alias("_at"), F.lit(0).alias("_kind"), have.alias("_have"), F.lit(None).cast(row_type).alias("_row"))
    order = ["_key", "_at", "_kind", "_have"]
    ranged = known.unionByName(probes).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = written(ranged.withColumn("_range", F.spark_partition_id()), "as-of-ranges")
    so_far = Window.partitionBy("_key", "_range").orderBy("_at", "_kind", "_have").rowsBetween(Window.unboundedPreceding, 0)
    held = ranged.withColumn("_held", F.last("_have", ignorenulls=True).over(so_far)).where("_kind = 1")
    ends = ranged.groupBy("_key", "_range").agg(F.max(F.when(F.col("_kind") == 0, F.struct("_at", "_have"))).alias("_end"))
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("_key").alias("_k"), F.col("_range").alias("_r"), F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
    carried = carried.where("_carry IS NOT NULL")
    joined = held.join(carried, (F.col("_key") == F.col("_k")) & (F.col("_range") == F.col("_r")), "left")
    best: Column = F.coalesce("_held", F.col("_carry._have"))
    return joined.select("_row.*", best["since"].alias(f"{since}_as_of"), best["payload"].alias(f"{payload}_as_of"))
