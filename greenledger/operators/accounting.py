"""Row accounting: every raw row comes to exactly one end, and nothing is lost unseen.

Each raw reading and incident is numbered once, in a written copy, and followed
through the same operators that build the facts. What does not arrive is asked why,
in the order in which it can get lost. Ends are counts that add up to the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import conform, facts, quality

# Ends of a row.
FACT = "FACT"                                  # a fact row came of it, of a quarter one at least
QUARANTINED = "QUARANTINED"                    # a rule of the book failed on it; the first is named
QUARANTINED_COPY = "QUARANTINED_COPY"          # another row of the same id was quarantined
NOT_CONVERTED = "NOT_CONVERTED"                # passed the rules, yet no metric or factor is found for it
SUPERSEDED = "SUPERSEDED"                      # another submission of the same cell, or copy of the id, won
NO_DATE = "NO_DATE"                            # no month or day to count for
UNKNOWN_SITE = "UNKNOWN_SITE"
UNSUPPORTED_PERIOD = "UNSUPPORTED_PERIOD"      # won its cell, but counts neither for a month nor a quarter
OUT_OF_WINDOW = "OUT_OF_WINDOW"
BEFORE_ACQUISITION = "BEFORE_ACQUISITION"
AFTER_DIVESTMENT = "AFTER_DIVESTMENT"
BETWEEN_VERSIONS = "BETWEEN_VERSIONS"

ROW = "_row"
LEDGER_COLUMNS = ["source", "row_id", "end", "rule_id"]


def _spans(dim_site: DataFrame, month: bool) -> DataFrame:
    """Per site: the first and last day (or month) of any version."""
    lo = F.trunc("valid_from", "month") if month else F.col("valid_from")
    hi = F.coalesce("valid_to", F.lit(facts.OPEN_END).cast("date"))
    return dim_site.groupBy(F.col("site_id").alias("_sid")).agg(
        F.min(lo).alias("_first"), F.max(F.trunc(hi, "month") if month else hi).alias("_last"))


def _where(day: Column) -> Column:
    """Why no version of a known site is valid then."""
    return (F.when(day < F.col("_first"), F.lit(BEFORE_ACQUISITION))
            .when(day > F.col("_last"), F.lit(AFTER_DIVESTMENT)).otherwise(F.lit(BETWEEN_VERSIONS)))


def _ledger(rows: DataFrame, source: str, id_col: str, end: Column, rule: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return rows.select(F.lit(source).alias("source"), F.col(id_col).cast("string").alias("row_id"), end.alias("end"),
                       (none if rule is None else rule).alias("rule_id"))


def reading_ends(flagged: DataFrame, columns: Sequence[str], rules: Sequence[quality.Rule], stg_metrics: DataFrame,
                 stg_uom: DataFrame, dim_site: DataFrame, dim_date: DataFrame, dim_metric: DataFrame) -> DataFrame:
    """The end of every raw reading. ``flagged`` are the flagged readings with a number
    of their own (``_row``), written, as all is joined by it; ``columns`` the raw ones."""
    own = quality.own_failure(rules)
    first_rule = F.coalesce(*[F.when(F.col(quality.failure_column(r)) > 0, F.lit(r.rule_id)) for r in rules
                              if r.reason is not None and not r.is_group_rule], F.lit(None).cast("string"))
    quarantined = _ledger(flagged.where(own), "readings", "reading_id", F.lit(QUARANTINED), first_rule)
    # one join, written, tells copies of quarantined ids from what is kept
    failing = flagged.where(own).where("reading_id IS NOT NULL").select("reading_id").distinct().withColumn("_copy", F.lit(True))
    rest = written(flagged.where(~own).select(*columns, ROW).join(failing, "reading_id", "left"), "numbered-rest")
    copies, kept = rest.where("_copy").drop("_copy"), rest.where("_copy IS NULL").drop("_copy")

    typed = conform.typed_readings(kept, carry=[ROW])
    converted = conform.canonical_units(typed, stg_metrics, stg_uom, carry=[ROW])
    cell = ["site_id", "period_start", "metric_code"]
    winners = conform.top_per_key(converted, cell, [F.col("submitted_at"), F.col("reading_id")])
    values = facts.monthly_values(winners.withColumn("is_restatement", F.lit(False)), carry=[ROW])
    sites = _spans(dim_site, True)
    arrived = facts.fact_monthly(values, dim_site, dim_date, dim_metric, carry=[ROW]).select(ROW).distinct()
    months = dim_date.select(F.col("month_start").alias("value_month"), F.lit(True).alias("_inside"))
    # of a winner that came to nothing: the last of its months inside the window, or outside
    lost = (values.join(arrived, ROW, "left_anti").join(months, "value_month", "left")
            .groupBy(ROW).agg(F.max(F.when(F.col("_inside"), F.col("value_month"))).alias("_month"),
                              F.max("site_id").alias("_sid"), F.max("value_month").alias("_any")))
    lost = lost.join(sites, "_sid", "left").select(ROW, (
        F.when(F.col("_any").isNull(), F.lit(NO_DATE)).when(F.col("_first").isNull(), F.lit(UNKNOWN_SITE))
        .when(F.col("_month").isNull(), F.lit(OUT_OF_WINDOW)).otherwise(_where(F.col("_month")))).alias("end"))
    ends = (arrived.select(ROW, F.lit(FACT).alias("end")).unionByName(lost)
            .unionByName(winners.where(~F.coalesce(F.col("period_type").isin("M", "Q"), F.lit(False)))
                         .select(ROW, F.lit(UNSUPPORTED_PERIOD).alias("end"))))
    # converted are those whose metric and unit the catalogues pair, told without their rows
    pairs = stg_metrics.select("metric_code", "canonical_uom").join(
        stg_uom.select(F.col("from_uom").alias("source_uom"), F.col("to_uom").alias("canonical_uom")), "canonical_uom")
    pairs = pairs.select("metric_code", "source_uom").distinct().withColumn("_converted", F.lit(True))
    # the id as it was submitted goes along beside the typed one
    asked = conform.typed_readings(kept.withColumn("_id", F.col("reading_id")), carry=[ROW, "_id"])
    followed = (asked.select(ROW, F.col("_id").alias("reading_id"), "metric_code", "source_uom")
                .join(pairs, ["metric_code", "source_uom"], "left").join(ends, ROW, "left"))
    end = F.when(F.col("_converted").isNull(), F.lit(NOT_CONVERTED)).otherwise(F.coalesce("end", F.lit(SUPERSEDED)))
    return (quarantined.unionByName(_ledger(copies, "readings", "reading_id", F.lit(QUARANTINED_COPY)))
            .unionByName(_ledger(followed, "readings", "reading_id", end)))


def incident_ends(numbered: DataFrame, dim_site: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The end of every raw incident; ``numbered`` are the raw ones with a number of
    their own (``_row``), written."""
    typed = conform.typed_incidents(numbered, carry=[ROW])
    winners = conform.dedupe_priority(typed)
    arrived = facts.fact_incident(winners, dim_site, dim_date, carry=[ROW]).select(ROW).distinct()
    months = dim_date.select(F.col("month_start").alias("_m"), F.lit(True).alias("_inside"))
    lost = (winners.join(arrived, ROW, "left_anti").select(ROW, F.col("site_id").alias("_sid"), "incident_date")
            .join(months, F.trunc("incident_date", "month") == F.col("_m"), "left").join(_spans(dim_site, False), "_sid", "left"))
    lost = lost.select(ROW, (
        F.when(F.col("incident_date").isNull(), F.lit(NO_DATE)).when(F.col("_first").isNull(), F.lit(UNKNOWN_SITE))
        .when(F.col("_inside").isNull(), F.lit(OUT_OF_WINDOW)).otherwise(_where(F.col("incident_date")))).alias("end"))
    ends = arrived.select(ROW, F.lit(FACT).alias("end")).unionByName(lost)
    return _ledger(numbered.join(ends, ROW, "left"), "incidents", "incident_id", F.coalesce("end", F.lit(SUPERSEDED)))


def row_accounting(ledger: DataFrame) -> DataFrame:
    """(source, end, rule_id, row_count): the ledger added up."""
    return ledger.groupBy("source", "end", "rule_id").agg(F.count(F.lit(1)).alias("row_count"))
