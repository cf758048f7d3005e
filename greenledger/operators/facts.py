"""Facts: monthly metric values and incidents on surrogate keys.

Both facts look a site version up by (site_id, date inside validity). The
equi part (site_id) drives a hash or sort-merge join, as the planner chooses
by the dimension's bytes, and the validity bounds are a residual predicate;
no nested-loop join appears.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_MONTHLY_COLUMNS = ["site_key", "date_key", "metric_key", "reading_id", "value", "uom",
                        "source_system", "submitted_at", "is_restatement", "is_estimated"]
FACT_INCIDENT_COLUMNS = ["incident_id", "site_key", "date_key", "incident_date",
                         "incident_type", "severity", "is_recordable", "lost_days",
                         "reported_by"]
VALUE_COLUMNS = ["reading_id", "site_id", "value_month", "metric_code", "month_value",
                 "canonical_uom", "source_system", "submitted_at", "is_restatement",
                 "is_estimated"]

OPEN_END = "9999-12-31"
QUARTER_MONTHS = 3


def monthly_values(stg_readings: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per reading and month it counts for, in a single scan. A monthly
    row is kept as it is; a quarterly row is labelled with the quarter's last
    month and becomes three rows (that month and the two before), each a third
    of the value and flagged as estimated."""
    is_q = F.col("period_type") == F.lit("Q")
    back = F.when(is_q, F.sequence(F.lit(0), F.lit(QUARTER_MONTHS - 1))) \
        .otherwise(F.array(F.lit(0)))
    rows = (stg_readings.where(F.col("period_type").isin("M", "Q"))
            .withColumn("_back", F.explode(back)))
    return rows.select(
        "reading_id", "site_id",
        F.add_months("period_start", -F.col("_back")).alias("value_month"),
        "metric_code",
        F.when(is_q, F.col("canonical_value") / F.lit(float(QUARTER_MONTHS)))
        .otherwise(F.col("canonical_value")).alias("month_value"),
        "canonical_uom", "source_system", "submitted_at", "is_restatement",
        is_q.alias("is_estimated"), *carry)


def quarterly_allocation(stg_readings: DataFrame) -> DataFrame:
    """The allocated rows of the quarterly readings alone."""
    return monthly_values(stg_readings.where(F.col("period_type") == F.lit("Q")))


def _month_bounds(dim_site: DataFrame) -> DataFrame:
    return dim_site.select(
        "site_key", F.col("site_id").alias("_sid"),
        F.trunc("valid_from", "month").alias("_lo"),
        F.trunc(F.coalesce("valid_to", F.lit(OPEN_END).cast("date")), "month").alias("_hi"))


def fact_monthly(values: DataFrame, dim_site: DataFrame, dim_date: DataFrame,
                 dim_metric: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Site version valid in the month (month-truncated, inclusive bounds),
    month inside the reporting window, metric known."""
    sites = _month_bounds(dim_site)
    dates = dim_date.select("date_key", F.col("month_start").alias("_m"))
    metrics = dim_metric.select("metric_key", F.col("metric_code").alias("_c"))
    v = values
    j = (v.join(sites, (v["site_id"] == sites["_sid"])
                & (v["value_month"] >= sites["_lo"]) & (v["value_month"] <= sites["_hi"]))
         .join(dates, F.col("value_month") == F.col("_m"))
         .join(metrics, F.col("metric_code") == F.col("_c")))
    return j.select("site_key", "date_key", "metric_key", "reading_id",
                    F.col("month_value").alias("value"), F.col("canonical_uom").alias("uom"),
                    "source_system", "submitted_at", "is_restatement", "is_estimated", *carry)


def fact_incident(stg_incidents: DataFrame, dim_site: DataFrame, dim_date: DataFrame,
                  carry: Sequence[str] = ()) -> DataFrame:
    """Site version valid on the incident's day (day granularity, inclusive),
    bucketed to its month's ``date_key``."""
    sites = dim_site.select(
        "site_key", F.col("site_id").alias("_sid"), F.col("valid_from").alias("_lo"),
        F.coalesce("valid_to", F.lit(OPEN_END).cast("date")).alias("_hi"))
    dates = dim_date.select("date_key", F.col("month_start").alias("_m"))
    i = stg_incidents
    j = (i.join(sites, (i["site_id"] == sites["_sid"])
                & (i["incident_date"] >= sites["_lo"]) & (i["incident_date"] <= sites["_hi"]))
         .join(dates, F.trunc("incident_date", "month") == F.col("_m")))
    return j.select(*FACT_INCIDENT_COLUMNS, *carry)
