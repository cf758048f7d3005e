"""KPIs that keep a missing month distinguishable from a zero.

Every site-level KPI starts from the *active spine*: one row per site
version and month it is consolidated in. Measures arrive by LEFT join, so
a month without a submission stays NULL; nothing is ``fillna(0)``-ed
except incident counts, where "no incident reported" is a true zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dims import ReportingWindow
from .facts import OPEN_END

# KPI constants.
TRIR_BASIS = 200000.0        # recordable incidents per 200,000 hours worked
ROLLING_MONTHS = 12
INTENSITY_BASIS = 1000.0     # MWh per 1,000 hours worked

SPINE_COLUMNS = ["date_key", "month_start", "period", "site_key", "site_id", "site_name",
                 "business_unit", "region"]


def active_spine(dim_site: DataFrame, dim_date: DataFrame, window: ReportingWindow) -> DataFrame:
    """(site version x month) where the month lies in the version's validity,
    bounds month-truncated and inclusive, clipped to the window. Each
    version explodes its own month range (bounded by the window length), so
    there is no theta join of dates against sites."""
    lo = F.trunc("valid_from", "month")
    hi = F.trunc(F.coalesce("valid_to", F.lit(OPEN_END).cast("date")), "month")
    first = F.greatest(lo, F.lit(window.first_month))
    last = F.least(hi, F.lit(window.last_month))
    months = F.when(lo.isNotNull() & (first <= last),
                    F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))
    sites = dim_site.select("site_key", "site_id", "site_name", "business_unit", "region",
                            F.explode(months).alias("month_start"))
    dates = dim_date.select("date_key", "month_start", "period")
    return sites.join(dates, "month_start").select(*SPINE_COLUMNS)


def metric_pivot(fact: DataFrame, dim_metric: DataFrame,
                 measures: Sequence[tuple[str, str]],
                 flags: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """Per (site_key, date_key): ``max(value)`` of each metric code in
    ``measures`` (code, alias) and ``max(column)`` for each ``flags`` entry
    (code, column, alias). Only the listed codes are read."""
    codes = sorted({c for c, _ in measures} | {c for c, _, _ in flags})
    metrics = dim_metric.where(F.col("metric_code").isin(*codes)).select("metric_key", "metric_code")
    f = fact.join(metrics, "metric_key")
    aggs = [F.max(F.when(F.col("metric_code") == F.lit(code), F.col("value"))).alias(alias)
            for code, alias in measures]
    aggs += [F.max(F.when(F.col("metric_code") == F.lit(code), F.col(col))).alias(alias)
             for code, col, alias in flags]
    return f.groupBy("site_key", "date_key").agg(*aggs)


def kpi_emissions(spine: DataFrame, fact: DataFrame, dim_metric: DataFrame) -> DataFrame:
    """Scope 1 + 2 per site and month; the total is NULL when either scope
    is missing, never a partial sum."""
    p = metric_pivot(fact, dim_metric, [("SCOPE1_GHG", "scope1_tco2e"),
                                        ("SCOPE2_GHG", "scope2_tco2e")])
    j = spine.join(p, ["site_key", "date_key"], "left")
    return j.select("period", "site_id", "site_name", "business_unit", "region",
                    "scope1_tco2e", "scope2_tco2e",
                    (F.col("scope1_tco2e") + F.col("scope2_tco2e")).alias("total_tco2e"))


def kpi_energy_intensity(spine: DataFrame, fact: DataFrame, dim_metric: DataFrame,
                         basis: float = INTENSITY_BASIS) -> DataFrame:
    """MWh per 1,000 hours; NULL if either side is missing or hours are 0.
    ``is_estimated``: the hours came from a quarterly allocation."""
    p = metric_pivot(fact, dim_metric,
                     [("ENERGY_CONS", "energy_mwh"), ("HOURS_WORKED", "hours_worked")],
                     [("HOURS_WORKED", "is_estimated", "hours_allocated")])
    j = spine.join(p, ["site_key", "date_key"], "left")
    e, h = F.col("energy_mwh"), F.col("hours_worked")
    ratio = F.when(e.isNotNull() & h.isNotNull() & (h != 0), e * F.lit(basis) / h)
    return j.select("period", "site_id", "site_name", "energy_mwh", "hours_worked",
                    ratio.alias("mwh_per_1000_hours"),
                    F.coalesce("hours_allocated", F.lit(False)).alias("is_estimated"))


def monthly_recordables(fact_incident: DataFrame) -> DataFrame:
    """Recordable incidents per (site_key, date_key) that has any incident."""
    return fact_incident.groupBy("site_key", "date_key").agg(
        F.count_if(F.col("is_recordable") == F.lit(True)).alias("recordable_incidents"))


def hours_by_month(fact: DataFrame, dim_metric: DataFrame) -> DataFrame:
    """Hours-worked fact rows, not aggregated (one per fact row)."""
    m = dim_metric.where(F.col("metric_code") == F.lit("HOURS_WORKED")).select("metric_key")
    return fact.join(m, "metric_key").select("site_key", "date_key",
                                             F.col("value").alias("hours_worked"))


def rolling_12m(spine: DataFrame, recordables: DataFrame, hours: DataFrame,
                months: int = ROLLING_MONTHS) -> DataFrame:
    """Trailing ``months``-row sums per site version: incidents (a month
    with none counts 0), hours (NULL months skipped), rows in the window and
    rows with hours. One window, partitioned by site_key: partitions are
    bounded by the window length, never by data volume."""
    base = (spine.join(recordables, ["site_key", "date_key"], "left")
            .join(hours, ["site_key", "date_key"], "left")
            .select("period", "month_start", "site_key", "site_id", "site_name",
                    F.coalesce("recordable_incidents", F.lit(0).cast("bigint"))
                    .alias("recordable_incidents"), "hours_worked"))
    w = (Window.partitionBy("site_key")
         .orderBy(F.col("month_start").asc(), F.col("hours_worked").asc_nulls_last(),
                  F.col("recordable_incidents").asc())
         .rowsBetween(-(months - 1), 0))
    return base.select(
        "period", "month_start", "site_key", "site_id", "site_name",
        F.sum("recordable_incidents").over(w).cast("bigint").alias("recordable_incidents_r12"),
        F.sum("hours_worked").over(w).alias("hours_worked_r12"),
        F.count(F.lit(1)).over(w).alias("window_rows"),
        F.count("hours_worked").over(w).alias("hours_rows"))


def kpi_trir(rolling: DataFrame, basis: float = TRIR_BASIS,
             months: int = ROLLING_MONTHS) -> DataFrame:
    """Rolling TRIR = incidents x basis / hours, published only for a full
    window with hours in every month; the sums are shown regardless."""
    full = (F.col("window_rows") == months) & (F.col("hours_rows") == months)
    h = F.col("hours_worked_r12")
    rate = F.when((F.col("window_rows") >= months) & (F.col("hours_rows") >= months)
                  & h.isNotNull() & (h != 0),
                  F.col("recordable_incidents_r12") * F.lit(basis) / h)
    return rolling.select("period", "site_id", "site_name", "recordable_incidents_r12",
                          "hours_worked_r12", rate.alias("trir_r12"),
                          full.alias("has_full_window"))


def strict_sum(value: str | Column) -> Column:
    """``sum`` only when every input is present, else NULL."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(F.count(v) == F.count(F.lit(1)), F.sum(v))


def strict_rollup(df: DataFrame, group_cols: Sequence[str], value: str,
                  alias: str | None = None) -> DataFrame:
    return df.groupBy(*group_cols).agg(strict_sum(value).alias(alias or value))


def two_level_rollup(emissions: DataFrame) -> DataFrame:
    """Strict monthly totals at GROUP and BUSINESS_UNIT level in one scan
    (``GROUPING SETS``), the level read from ``grouping_id``."""
    g = emissions.groupingSets([["period"], ["period", "business_unit"]],
                               "period", "business_unit")
    agg = g.agg(strict_sum("total_tco2e").alias("total_tco2e"),
                F.grouping_id().alias("_gid"))
    group_level = F.col("_gid") == 1  # business_unit aggregated away
    return agg.select(
        "period",
        F.to_date(F.concat(F.col("period"), F.lit("-01"))).alias("month_start"),
        F.when(group_level, F.lit("GROUP")).otherwise(F.lit("BUSINESS_UNIT"))
        .alias("grouping_level"),
        F.when(group_level, F.lit("GROUP")).otherwise(F.col("business_unit"))
        .alias("grouping_value"),
        "total_tco2e")


def kpi_yoy(rollup: DataFrame) -> DataFrame:
    """Year-over-year change per level and value: the same month one year
    earlier, found by a RANGE frame of exactly -12 months on a month index
    (a missing month stays missing, unlike ``lag(12)``). ``yoy_pct`` is a
    fraction, NULL when last year is missing or zero."""
    idx = F.year("month_start") * 12 + F.month("month_start")
    w = (Window.partitionBy("grouping_level", "grouping_value").orderBy("_idx")
         .rangeBetween(-12, -12))
    with_ly = rollup.withColumn("_idx", idx).withColumn(
        "total_tco2e_ly",
        F.when(F.col("grouping_value").isNotNull(), F.max("total_tco2e").over(w)))
    t, ly = F.col("total_tco2e"), F.col("total_tco2e_ly")
    return with_ly.select(
        "period", "grouping_level", "grouping_value", "total_tco2e", "total_tco2e_ly",
        F.when(t.isNotNull() & ly.isNotNull(), t - ly).alias("yoy_abs"),
        F.when(t.isNotNull() & ly.isNotNull() & (ly != 0), (t - ly) / ly).alias("yoy_pct"))


def like_for_like(emissions: DataFrame) -> DataFrame:
    """Year-over-year change over the sites that are complete in both months, summed after
    the perimeter is cut: ``sites`` are those that count, and a month in which a level has
    none has no row. A site that came, left or missed a month changes no figure."""
    idx = F.substring("period", 1, 4).cast("int") * 12 + F.substring("period", 6, 2).cast("int")
    w = Window.partitionBy("site_id").orderBy("_idx").rangeBetween(-12, -12)
    both = (emissions.where("site_id IS NOT NULL AND total_tco2e IS NOT NULL").withColumn("_idx", idx)
            .withColumn("_ly", F.max("total_tco2e").over(w)).where("_ly IS NOT NULL"))
    g = both.groupingSets([["period"], ["period", "business_unit"]], "period", "business_unit")
    agg = g.agg(F.countDistinct("site_id").alias("sites"), F.sum("total_tco2e").alias("total_tco2e"),
                F.sum("_ly").alias("total_tco2e_ly"), F.grouping_id().alias("_gid"))
    group, t, ly = F.col("_gid") == 1, F.col("total_tco2e"), F.col("total_tco2e_ly")
    return agg.select(
        "period", F.when(group, F.lit("GROUP")).otherwise(F.lit("BUSINESS_UNIT")).alias("grouping_level"),
        F.when(group, F.lit("GROUP")).otherwise(F.col("business_unit")).alias("grouping_value"), "sites", "total_tco2e",
        "total_tco2e_ly", (t - ly).alias("lfl_abs"), F.when(ly != 0, (t - ly) / ly).alias("lfl_pct"))
