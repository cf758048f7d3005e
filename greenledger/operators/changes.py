"""What changed between two snapshots: rows of raw tables, values of published ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

#: The column of a change set: how many more copies of the row there are now.
DELTA = "_delta"


def _row_keys(columns: Sequence[str]) -> list[Column]:
    """Two hashes of a whole row, in which a null is not like any value."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return [F.xxhash64(*values).alias("_h1"), F.xxhash64(F.lit(1), *values).alias("_h2")]


def changed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of one snapshot that the other has not, or has more or fewer copies of:
    the columns of ``new`` and by how many copies it has more (``_delta``, not 0).

    Both snapshots are reduced to fixed-width hashes, combined map-side, and only
    these are shuffled; the rows of the hashes that do not cancel out are fetched
    and counted by their full content."""
    columns = new.columns

    def hashed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*_row_keys(columns), F.lit(sign).alias("_n"))

    differing = (hashed(old, -1).unionByName(hashed(new, 1)).groupBy("_h1", "_h2")
                 .agg(F.sum("_n").alias("_n")).where("_n <> 0").select("_h1", "_h2"))
    differing = written(differing, "changed-hashes")

    def fetched(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*columns, *_row_keys(columns)).join(differing, ["_h1", "_h2"], "left_semi")
        return rows.select(*columns, F.lit(sign).alias("_n"))

    return (fetched(old, -1).unionByName(fetched(new, 1)).groupBy(*columns)
            .agg(F.sum("_n").alias(DELTA)).where(F.col(DELTA) != 0))


# ----------------------------------------------------------- restatement ledger
FIRST, CHANGED, WITHDRAWN = "FIRST", "CHANGED", "WITHDRAWN"


def _matches(a: str, b: str, columns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return cond


def restatement_ledger(old: DataFrame, new: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """(keys.., measure, kind, old_value, new_value), one row per value that differs between
    two published snapshots of one table.

    FIRST: there was no value before, whether the row was missing or its value null.
    WITHDRAWN: there is none any more. CHANGED: both are there and differ. Keys may be
    null and match as equal; they must be unique in each snapshot, as the contract of
    the published tables has it. Measures are compared as doubles; of two NaNs none
    is a change. Equal values and rows that are null on both sides leave no trace."""
    def value(side: str, m: str) -> Column:
        return F.col(f"{side}.{m}").cast("double")

    entries = []
    for m in measures:
        was, now = value("o", m), value("n", m)
        kind = (F.when(was.isNull() & now.isNotNull(), F.lit(FIRST)).when(was.isNotNull() & now.isNull(), F.lit(WITHDRAWN))
                .when(was != now, F.lit(CHANGED)))
        entries.append(F.struct(F.lit(m).alias("measure"), kind.alias("kind"), was.alias("old_value"), now.alias("new_value")))
    # a row that only one side has takes its keys from there; a null key of both sides stays null
    in_new = F.col("n._here").isNotNull()
    key = [F.when(in_new, F.col(f"n.{k}")).otherwise(F.col(f"o.{k}")).alias(k) for k in keys]
    joined = old.select("*", F.lit(True).alias("_here")).alias("o").join(
        new.select("*", F.lit(True).alias("_here")).alias("n"), _matches("o", "n", keys), "full_outer")
    rows = joined.select(*key, F.explode(F.array(*entries)).alias("e")).where("e.kind IS NOT NULL")
    return rows.select(*keys, "e.measure", "e.kind", "e.old_value", "e.new_value")


def replayed(values: DataFrame, ledgers: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The values (keys.., measure, value) that follow from earlier ones and the ledgers since,
    in their order: each value is what its last entry left, withdrawn ones are gone."""
    events = values.select(*keys, "measure", F.lit(0).alias("_at"), F.col("value").alias("_v"))
    for at, ledger in enumerate(ledgers, 1):
        events = events.unionByName(ledger.select(*keys, "measure", F.lit(at).alias("_at"), F.col("new_value").alias("_v")))
    last = events.groupBy(*keys, "measure").agg(F.max_by("_v", "_at").alias("value"))
    return last.where("value IS NOT NULL")


def long_values(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """(keys.., measure, value) of every value that is there."""
    entries = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
    return df.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.measure", "e.value").where("value IS NOT NULL")
