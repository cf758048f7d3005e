"""Output contracts and data checks, as distributed aggregates.

Structural checks (required outputs, column names and order) look at
plans only. Data checks return small DataFrames (one row per check) so a
caller can persist them, assert on them, or publish them next to a report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# KPI output contract, name -> columns in order.
KPI_CONTRACT: dict[str, list[str]] = {
    "kpi_emissions": ["period", "site_id", "site_name", "business_unit", "region",
                      "scope1_tco2e", "scope2_tco2e", "total_tco2e"],
    "kpi_energy_intensity": ["period", "site_id", "site_name", "energy_mwh", "hours_worked",
                             "mwh_per_1000_hours", "is_estimated"],
    "kpi_trir": ["period", "site_id", "site_name", "recordable_incidents_r12",
                 "hours_worked_r12", "trir_r12", "has_full_window"],
    "kpi_yoy": ["period", "grouping_level", "grouping_value", "total_tco2e",
                "total_tco2e_ly", "yoy_abs", "yoy_pct"],
}

# Marts every build must produce (contract names).
REQUIRED_MARTS = ["dim_site", "dim_metric", "dim_date", "fact_eqs_monthly", "fact_incident"]

DQ_REPORT_COLUMNS = ["rule_id", "rule_name", "severity", "rows_checked", "rows_failed",
                     "action_taken"]


class ContractError(RuntimeError):
    pass


def check_required(outputs: Mapping[str, DataFrame], required: Sequence[str]) -> None:
    missing = [name for name in required if name not in outputs]
    if missing:
        raise ContractError("required outputs that were not built: " + ", ".join(missing))


def check_columns(df: DataFrame, expected: Sequence[str], name: str = "output") -> None:
    if list(df.columns) != list(expected):
        raise ContractError(f"{name} columns are wrong: expected {list(expected)}, "
                            f"got {df.columns}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def check_unique(checks: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per (name, frame, keys): duplicated keys and rows involved."""
    parts = []
    for name, df, keys in checks:
        d = duplicate_keys(df, keys).agg(
            F.count(F.lit(1)).alias("duplicate_keys"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("duplicate_rows"))
        parts.append(d.select(F.lit(name).alias("check_name"), F.lit(",".join(keys))
                              .alias("keys"), "duplicate_keys", "duplicate_rows"))
    return _union(parts)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose ``key`` has no parent row (NULL keys are orphans)."""
    p = parent.select(F.col(key).alias("_pk")).distinct()
    return child.join(p, child[key] == p["_pk"], "left_anti")


def check_orphans(checks: Sequence[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    parts = []
    for name, child, parent, key in checks:
        parts.append(orphans(child, parent, key).agg(F.count(F.lit(1)).alias("orphan_rows"))
                     .select(F.lit(name).alias("check_name"), F.lit(key).alias("key"),
                             "orphan_rows"))
    return _union(parts)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_ranges(outputs: Mapping[str, DataFrame], first_period: str,
                 last_period: str) -> DataFrame:
    """One row of range, domain, coverage and cardinality facts about a
    build; each boolean is a pass/fail of one contract check."""
    def count_of(name: str) -> DataFrame:
        return outputs[name].agg(F.count(F.lit(1)).alias(f"{name}_rows"))

    trir = outputs["kpi_trir"].agg(
        F.min("trir_r12").alias("trir_min"), F.max("trir_r12").alias("trir_max"),
        F.count("trir_r12").alias("trir_values"))
    em = outputs["kpi_emissions"].agg(
        F.count(F.lit(1)).alias("kpi_emissions_rows"),
        F.max(F.col("period") == F.lit(first_period)).alias("covers_first"),
        F.max(F.col("period") == F.lit(last_period)).alias("covers_last"))
    yoy = outputs["kpi_yoy"].agg(
        F.count(F.lit(1)).alias("kpi_yoy_rows"),
        F.array_join(F.array_sort(F.collect_set("grouping_level")), ",").alias("yoy_levels"))
    others = [count_of(n) for n in ("dim_site", "dim_date", "dim_metric",
                                    "kpi_energy_intensity", "kpi_trir")]
    row = _one_row([trir, em, yoy] + others)
    return row.select(
        "*",
        (F.coalesce(F.col("trir_min"), F.lit(0.0)) >= 0).alias("trir_non_negative"),
        (F.coalesce(F.col("trir_max"), F.lit(0.0)) < 100).alias("trir_plausible"),
        (F.col("covers_first") & F.col("covers_last")).alias("covers_window"),
        (F.col("yoy_levels") == F.lit("BUSINESS_UNIT,GROUP")).alias("yoy_both_levels"),
        ((F.col("kpi_emissions_rows") > 0) & (F.col("kpi_energy_intensity_rows") > 0)
         & (F.col("kpi_trir_rows") > 0) & (F.col("kpi_yoy_rows") > 0)).alias("kpis_not_empty"))


def _one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Combine one-row frames into one row without a cross join: align the
    parts on the union of their columns (NULL elsewhere), union them and
    take ``max`` of every column (each column comes from exactly one part)."""
    fields: list[tuple[str, str]] = []
    for p in parts:
        fields += [(f.name, f.dataType.simpleString()) for f in p.schema.fields]
    aligned = []
    for p in parts:
        own = set(p.columns)
        aligned.append(p.select(*[F.col(n) if n in own else F.lit(None).cast(t).alias(n)
                                  for n, t in fields]))
    u = _union(aligned)
    return u.agg(*[F.max(n).alias(n) for n, _ in fields])


def check_dq_report(report: DataFrame, min_rules: int = 6, min_firing: int = 4) -> DataFrame:
    """One row: rule count, firing rules, ERROR present, every rule checked
    rows, and the overall verdict."""
    s = report.agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(F.col("rows_failed") > 0).alias("firing_rules"),
        F.coalesce(F.max(F.col("severity") == F.lit("ERROR")), F.lit(False)).alias("has_error_rule"),
        F.coalesce(F.min(F.col("rows_checked") > 0), F.lit(False)).alias("all_rules_checked_rows"))
    ok: Column = ((F.col("rules") >= min_rules) & (F.col("firing_rules") >= min_firing)
                  & F.col("has_error_rule") & F.col("all_rules_checked_rows"))
    return s.select("*", ok.alias("passes"))
