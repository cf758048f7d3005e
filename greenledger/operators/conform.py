"""Staging: typed, trimmed, unit-normalised and de-duplicated tables.

All casts go through the dialect-exact helpers in ``greenledger.functions``.
"Keep the best row per key" is a ``groupBy(key).agg(max(struct(...)))``:
the aggregate is combined map-side (after a local sort, as a struct has no
fixed-width buffer), so a key holding a third of all rows costs one partial
row per map task instead of one giant sort group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (blank_to_null, duck_bigint, duck_date, duck_double, duck_int,
                         duck_timestamp, month_start_of_period, ztrim)

# Country spellings normalised to ISO codes (after trim/upper).
COUNTRY_ALIASES = {"GERMANY": "DE", "USA": "US"}

# The reporter whose copy of a duplicated incident wins a tie
# on lost days.
PREFERRED_REPORTER = "EHS Officer"


def _yes(c: str) -> Column:
    """``upper(trim(x)) = 'Y'``; anything else, NULL included, is false."""
    return F.coalesce(F.upper(ztrim(c)) == F.lit("Y"), F.lit(False))


def conform_sites(raw_sites: DataFrame) -> DataFrame:
    country = F.upper(ztrim("country"))
    mapped = country
    for alias, code in COUNTRY_ALIASES.items():
        mapped = F.when(country == F.lit(alias), F.lit(code)).otherwise(mapped)
    return raw_sites.select(
        duck_int("site_id").alias("site_id"),
        ztrim("site_name").alias("site_name"),
        mapped.alias("country"),
        F.upper(ztrim("region")).alias("region"),
        ztrim("business_unit").alias("business_unit"),
        duck_int("headcount").alias("headcount"),
        duck_date("valid_from").alias("valid_from"),
        duck_date(blank_to_null("valid_to")).alias("valid_to"),
    )


def conform_metrics(raw_metrics: DataFrame) -> DataFrame:
    return raw_metrics.select(
        ztrim("metric_code").alias("metric_code"),
        ztrim("metric_name").alias("metric_name"),
        ztrim("category").alias("category"),
        ztrim("canonical_uom").alias("canonical_uom"),
        _yes("is_additive").alias("is_additive"),
    )


def conform_uom(raw_uom: DataFrame) -> DataFrame:
    return raw_uom.select(
        ztrim("from_uom").alias("from_uom"),
        ztrim("to_uom").alias("to_uom"),
        duck_double("factor").alias("conversion_factor"),
    )


def typed_readings(readings: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Raw readings (already stripped of quarantined ids) with types; columns to
    ``carry`` go along as they are."""
    return readings.select(
        duck_bigint("reading_id").alias("reading_id"),
        duck_int("site_id").alias("site_id"),
        month_start_of_period("period").alias("period_start"),
        ztrim("metric_code").alias("metric_code"),
        duck_double("value").alias("raw_value"),
        ztrim("uom").alias("source_uom"),
        F.upper(ztrim("period_type")).alias("period_type"),
        ztrim("source_system").alias("source_system"),
        duck_timestamp("submitted_at").alias("submitted_at"),
        *carry,
    )


def canonical_units(typed: DataFrame, stg_metrics: DataFrame, stg_uom: DataFrame,
                    carry: Sequence[str] = ()) -> DataFrame:
    """value x factor into the metric's canonical unit. Inner joins: a reading
    whose metric or unit pair is unknown does not reach the facts (such rows
    were quarantined by the quality rules already)."""
    metrics = stg_metrics.select("metric_code", "canonical_uom")
    factors = stg_uom.select(F.col("from_uom").alias("source_uom"),
                             F.col("to_uom").alias("canonical_uom"), "conversion_factor")
    return (typed.join(metrics, "metric_code")
            .join(factors, ["source_uom", "canonical_uom"])
            .select("reading_id", "site_id", "period_start", "metric_code", "raw_value",
                    "source_uom", "canonical_uom",
                    (F.col("raw_value") * F.col("conversion_factor")).alias("canonical_value"),
                    "period_type", "source_system", "submitted_at", *carry))


def top_per_key(df: DataFrame, keys: Sequence[str], priority: Sequence[Column],
                count_as: str | None = None) -> DataFrame:
    """The single highest-priority row per key (NULL keys form one group).

    ``priority`` is compared descending with NULLs last; remaining columns,
    in frame order, break any remaining tie so the result is deterministic.
    """
    payload = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(*[p.alias(f"_p{i}") for i, p in enumerate(priority)],
                          *[F.col(c) for c in payload])).alias("_best")
    aggs = [best] + ([F.count(F.lit(1)).alias(count_as)] if count_as else [])
    out = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) if k in keys else F.col(f"_best.{k}").alias(k) for k in df.columns]
    return out.select(*cols, *([F.col(count_as)] if count_as else []))


def latest_submission(converted: DataFrame) -> DataFrame:
    """Latest submission wins per (site, month, metric): newest
    ``submitted_at``, then highest ``reading_id``; counts the competing
    submissions and flags restatements."""
    keys = ["site_id", "period_start", "metric_code"]
    top = top_per_key(converted, keys, [F.col("submitted_at"), F.col("reading_id")],
                      count_as="submission_count")
    return top.select(
        "reading_id", "site_id", "period_start", "metric_code", "raw_value", "source_uom",
        "canonical_value", "canonical_uom", "period_type", "source_system", "submitted_at",
        "submission_count", (F.col("submission_count") > 1).alias("is_restatement"))


def typed_incidents(raw_incidents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return raw_incidents.select(
        duck_bigint("incident_id").alias("incident_id"),
        duck_int("site_id").alias("site_id"),
        duck_date("incident_date").alias("incident_date"),
        ztrim("incident_type").alias("incident_type"),
        ztrim("severity").alias("severity"),
        _yes("is_recordable").alias("is_recordable"),
        duck_int("lost_days").alias("lost_days"),
        ztrim("reported_by").alias("reported_by"),
        *carry,
    )


def dedupe_priority(incidents: DataFrame) -> DataFrame:
    """One row per incident id: most lost days, then the preferred
    reporter's copy, then the remaining columns as a total tie-break."""
    preferred = F.when(F.col("reported_by") == F.lit(PREFERRED_REPORTER), F.lit(1)) \
        .otherwise(F.lit(0))
    return top_per_key(incidents, ["incident_id"], [F.col("lost_days"), preferred])
