"""Dimensions: site versions, metrics and the month spine."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .keys import dense_key


@dataclass(frozen=True)
class ReportingWindow:
    """First month ``YYYY-MM`` and number of months of the reporting window."""
    start: str = "2024-01"
    months: int = 24

    @property
    def first_month(self) -> date:
        y, m = (int(x) for x in self.start.split("-"))
        return date(y, m, 1)

    @property
    def last_month(self) -> date:
        f = self.first_month
        idx = f.year * 12 + (f.month - 1) + self.months - 1
        return date(idx // 12, idx % 12 + 1, 1)


DIM_SITE_COLUMNS = ["site_key", "site_id", "site_name", "country", "region",
                    "business_unit", "headcount", "valid_from", "valid_to", "is_current"]
DIM_METRIC_COLUMNS = ["metric_key", "metric_code", "metric_name", "category",
                      "canonical_uom", "is_additive"]
DIM_DATE_COLUMNS = ["date_key", "month_start", "period", "year", "quarter",
                    "month_number", "month_name"]


def dim_site(stg_sites: DataFrame) -> DataFrame:
    """One row per site version, ``site_key`` dense by (site_id, valid_from);
    a version with no end date is the current one."""
    keyed = dense_key(stg_sites, ["site_id", "valid_from"], "site_key")
    return keyed.select(*DIM_SITE_COLUMNS[:-1], F.col("valid_to").isNull().alias("is_current"))


def dim_metric(stg_metrics: DataFrame) -> DataFrame:
    keyed = dense_key(stg_metrics, ["metric_code"], "metric_key")
    return keyed.select(*DIM_METRIC_COLUMNS)


def window_bounds(spark: SparkSession, window: ReportingWindow) -> DataFrame:
    """One row: the first and last month of a given window."""
    return spark.range(0, 1, 1, numPartitions=1).select(
        F.lit(window.first_month).alias("first"), F.lit(window.last_month).alias("last"))


def bounds_to_last_full_year(df: DataFrame, date_col: str, months: int) -> DataFrame:
    """One row: the ``months`` months that end with the last December present in
    ``df[date_col]``. One aggregate, combined map-side."""
    last = F.max(date_col)
    full_year = F.when(F.month(last) == 12, F.year(last)).otherwise(F.year(last) - 1)
    end = F.make_date(full_year, F.lit(12), F.lit(1))
    return df.agg(F.add_months(end, -(months - 1)).alias("first"), end.alias("last"))


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per month from ``first`` to ``last``, both inclusive."""
    spine = bounds.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MONTH")))
                          .alias("month_start"))
    return spine.select(
        F.date_format("month_start", "yyyyMM").cast("int").alias("date_key"),
        "month_start",
        F.date_format("month_start", "yyyy-MM").alias("period"),
        F.year("month_start").alias("year"),
        F.quarter("month_start").alias("quarter"),
        F.month("month_start").alias("month_number"),
        F.date_format("month_start", "MMMM").alias("month_name"))
