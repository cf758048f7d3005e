"""Declarative data-quality rules, evaluated in one distributed pass.

A rule is data: an id, a plain-language name, a severity, an action, a
check and (optionally) the reason written next to each offending row, so the
rule book below reads as a table.

Execution compiles every rule into columns of ONE enriched frame:

* each check contributes a ``checked`` and a ``failed`` weight per reading
  (usually 0/1; a lookup that fans out contributes its fan-out, exactly as
  the equivalent SQL join would count it);
* reference data (sites, metrics, unit pairs) is pre-aggregated to one row
  per join key, so enrichment multiplies no rows; how each lookup is joined
  is the planner's choice by its bytes;
* the report is a two-level aggregate: first by the duplicate-submission
  key (which also yields the group sizes the "multiple submissions" rule
  needs, combined map-side), then a global sum; one scan, one shuffle;
* the quarantine is the same frame filtered to failing rows and exploded to
  one row per (rule, failure): again one scan.

Rows are compared raw (untrimmed), as submitted: ``' MWh '`` is not a
known unit here even though staging would later trim it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null, duck_date, duck_double, duck_timestamp, \
    month_start_of_period

# Severities and actions of rules, columns of quarantine and report.
Severity = Literal["ERROR", "WARN", "INFO"]
Action = Literal["BLOCK", "QUARANTINE", "COERCE", "FLAG"]

DETAIL_COLUMNS = ["reading_id", "site_id", "period", "metric_code", "value"]
QUARANTINE_COLUMNS = ["rule_id"] + DETAIL_COLUMNS + ["reason"]
REPORT_COLUMNS = ["rule_id", "rule_name", "severity", "rows_checked", "rows_failed",
                  "action_taken"]


# --------------------------------------------------------------------- checks
@dataclass(frozen=True)
class Lookup:
    """A reference frame joined to every reading: one row per join key."""
    name: str
    frame: DataFrame
    on: tuple[tuple[str, str], ...]  # (reading column, lookup column)


@dataclass(frozen=True)
class KeyedAgg:
    """Aggregates of one reference table per key value, joined to every
    reading on ``column == ref_table.key``. Specs of all rules that share
    (table, key, column) become ONE per-key aggregate and ONE join."""
    table: str
    key: str
    column: str
    aggs: tuple[tuple[str, Column], ...]

    @property
    def name(self) -> str:
        return f"{self.table}_{self.key}_{self.column}"


def _kcol(table: str, key: str, column: str, agg: str) -> Column:
    return F.col(f"_lk_{table}_{key}_{column}_{agg}")


def lookup_column(table: str, key: str, column: str, agg: str) -> Column:
    """An aggregate of a KeyedAgg on a flagged row."""
    return _kcol(table, key, column, agg)


class Check:
    """How a rule decides, per reading, what it checked and what failed."""

    group_keys: tuple[str, ...] = ()
    # Checks every row exactly once (rows_checked = number of readings); no
    # weight column is stored for them.
    unit_checked: bool = True

    def keyed_aggs(self) -> list[KeyedAgg]:
        return []

    def parsed(self) -> dict[str, Column]:
        """Typed views of raw columns this check reads, computed once per row
        and shared by every rule that needs them."""
        return {}

    def lookups(self, refs: Mapping[str, DataFrame]) -> list[Lookup]:
        return []

    def checked(self, p: str) -> Column:
        return F.lit(1)

    def failed(self, p: str) -> Column:
        raise NotImplementedError


def _flag(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), F.lit(1)).otherwise(F.lit(0))


def _num(column: str) -> str:
    return f"_num_{column}"


def _ts(column: str) -> str:
    return f"_ts_{column}"


def _month(column: str) -> str:
    return f"_month_{column}"


@dataclass(frozen=True)
class IsNumeric(Check):
    column: str

    def parsed(self):
        return {_num(self.column): duck_double(self.column)}

    def failed(self, p: str) -> Column:
        return _flag(F.col(_num(self.column)).isNull())


@dataclass(frozen=True)
class IsTimestamp(Check):
    column: str

    def parsed(self):
        return {_ts(self.column): duck_timestamp(self.column)}

    def failed(self, p: str) -> Column:
        return _flag(F.col(_ts(self.column)).isNull())


@dataclass(frozen=True)
class InDomain(Check):
    column: str
    allowed: tuple[str, ...]

    def failed(self, p: str) -> Column:
        c = F.col(self.column)
        return _flag(c.isNull() | ~c.isin(*self.allowed))


@dataclass(frozen=True)
class NotNegative(Check):
    column: str
    code_column: str
    codes: tuple[str, ...]

    def parsed(self):
        return {_num(self.column): duck_double(self.column)}

    def failed(self, p: str) -> Column:
        return _flag((F.col(_num(self.column)) < 0) & F.col(self.code_column).isin(*self.codes))


@dataclass(frozen=True)
class ExistsIn(Check):
    """The reading's ``column`` equals some ``ref_table.ref_column``."""
    column: str
    ref_table: str
    ref_column: str

    def keyed_aggs(self):
        return [KeyedAgg(self.ref_table, self.ref_column, self.column,
                         (("found", F.max(F.lit(True))),))]

    def failed(self, p: str) -> Column:
        return _flag(_kcol(self.ref_table, self.ref_column, self.column, "found").isNull())


@dataclass(frozen=True)
class ConvertibleUnit(Check):
    """A reading of a defined metric has a conversion from its unit to the
    metric's canonical unit. Readings of undefined metrics pass (another
    rule reports them). ``checked`` counts reading x metric-row x
    conversion-row combinations, like the left-join formulation."""
    code_column: str = "metric_code"
    unit_column: str = "uom"
    unit_checked = False

    def keyed_aggs(self):
        return [KeyedAgg("metric_definitions", "metric_code", self.code_column,
                         (("rows", F.count(F.lit(1))),))]

    def lookups(self, refs):
        m = (refs["metric_definitions"].where(F.col("metric_code").isNotNull())
             .groupBy("metric_code", "canonical_uom").agg(F.count(F.lit(1)).alias("m_n")))
        c = (refs["uom_conversions"].where(F.col("from_uom").isNotNull()
                                           & F.col("to_uom").isNotNull())
             .groupBy("from_uom", "to_uom").agg(F.count(F.lit(1)).alias("c_n")))
        pairs = (m.join(c, m["canonical_uom"] == c["to_uom"])
                 .groupBy(F.col("metric_code").alias("_code"), F.col("from_uom").alias("_unit"))
                 .agg(F.sum("m_n").alias("matched"),
                      F.sum(F.col("m_n") * F.col("c_n")).alias("matched_rows")))
        return [Lookup("unit_pairs", pairs,
                       ((self.code_column, "_code"), (self.unit_column, "_unit")))]

    def _parts(self, p: str) -> tuple[Column, Column, Column]:
        total = _kcol("metric_definitions", "metric_code", self.code_column, "rows")
        matched = F.coalesce(F.col(f"{p}unit_pairs_matched"), F.lit(0))
        rows = F.coalesce(F.col(f"{p}unit_pairs_matched_rows"), F.lit(0))
        return total, matched, rows

    def checked(self, p: str) -> Column:
        total, matched, rows = self._parts(p)
        return F.when(total.isNull(), F.lit(1)).otherwise(total - matched + rows)

    def failed(self, p: str) -> Column:
        total, matched, _ = self._parts(p)
        return F.when(total.isNull(), F.lit(0)).otherwise(total - matched)


@dataclass(frozen=True)
class WithinValidity(Check):
    """The reading's month lies inside the site's validity, both ends
    truncated to the month and inclusive; an open end never fails. Checked
    once per matching site version, and every version that the month is outside
    of is a failure; with ``any_version`` a reading is checked once and fails
    only outside of all versions. Readings of unknown sites are not in scope.
    Comparisons with an unparseable month or date are not failures."""
    site_column: str = "site_id"
    period_column: str = "period"
    any_version: bool = False
    unit_checked = False

    def keyed_aggs(self):
        versions = F.collect_list(F.struct(
            F.trunc(duck_date("valid_from"), "month").alias("lo"),
            F.trunc(duck_date("valid_to"), "month").alias("hi"),
            blank_to_null("valid_to").isNotNull().alias("closed")))
        return [KeyedAgg("sites", "site_id", self.site_column, (("versions", versions),))]

    def parsed(self):
        return {_month(self.period_column): month_start_of_period(self.period_column)}

    def _versions(self, p: str) -> Column:
        return _kcol("sites", "site_id", self.site_column, "versions")

    def checked(self, p: str) -> Column:
        v = self._versions(p)
        n = F.lit(1) if self.any_version else F.size(v)
        return F.when(v.isNull(), F.lit(0)).otherwise(n)

    def failed(self, p: str) -> Column:
        v = self._versions(p)
        month = F.col(_month(self.period_column))
        outside = F.filter(v, lambda x: (month < x["lo"]) | (x["closed"] & (month > x["hi"])))
        n = F.size(outside)
        if self.any_version:
            n = F.when(n == F.size(v), F.lit(1)).otherwise(F.lit(0))
        return F.when(v.isNull(), F.lit(0)).otherwise(n)


@dataclass(frozen=True)
class ValidPeriod(Check):
    """The reading's ``column`` is a month."""
    column: str = "period"

    def parsed(self):
        return {_month(self.column): month_start_of_period(self.column)}

    def failed(self, p: str) -> Column:
        return _flag(F.col(_month(self.column)).isNull())


@dataclass(frozen=True)
class UniqueSubmission(Check):
    """More than one row shares the key; every row of such a group fails.
    A NULL key part never matches anything."""
    keys: tuple[str, ...] = ("site_id", "period", "metric_code")

    @property
    def group_keys(self) -> tuple[str, ...]:  # type: ignore[override]
        return self.keys

    def failed(self, p: str) -> Column:  # evaluated per group, see dq_report
        raise TypeError("group rule")


# ---------------------------------------------------------------------- rules
@dataclass(frozen=True)
class Rule:
    rule_id: str
    rule_name: str
    severity: Severity
    action: Action
    check: Check = field(compare=False)
    reason: str | None = None  # None: counted in the report, no quarantine rows

    @property
    def is_group_rule(self) -> bool:
        return bool(self.check.group_keys)


# Emission-relevant metric codes that may not be negative; the period types below.
NON_NEGATIVE_CODES = ("SCOPE1_GHG", "SCOPE2_GHG", "ENERGY_CONS", "WATER_WD",
                      "WASTE_TOTAL", "HOURS_WORKED")

# The rule book (ids, names, severities, actions, reasons).
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("DQ001", "reading value is numeric", "ERROR", "QUARANTINE",
         IsNumeric("value"), "value is not numeric"),
    Rule("DQ002", "reading references a known site", "ERROR", "QUARANTINE",
         ExistsIn("site_id", "sites", "site_id"), "site_id does not exist in the site master"),
    Rule("DQ003", "reading references a defined metric", "ERROR", "QUARANTINE",
         ExistsIn("metric_code", "metric_definitions", "metric_code"),
         "metric_code does not exist in metric definitions"),
    Rule("DQ004", "reading unit can be converted to the canonical unit", "ERROR", "QUARANTINE",
         ConvertibleUnit(), "unit cannot be converted to the metric canonical unit"),
    Rule("DQ005", "reading period is within the site consolidation period", "ERROR",
         "QUARANTINE", WithinValidity(), "reading is outside the site consolidation period"),
    Rule("DQ006", "reported metric values are not negative", "ERROR", "QUARANTINE",
         NotNegative("value", "metric_code", NON_NEGATIVE_CODES),
         "negative value is not accepted for this metric"),
    Rule("DQ007", "multiple submissions exist for the same site period and metric", "INFO",
         "FLAG", UniqueSubmission()),
    Rule("DQ008", "reading period type is supported", "ERROR", "QUARANTINE",
         InDomain("period_type", ("M", "Q")), "period_type must be M or Q"),
    Rule("DQ009", "reading submission timestamp is valid", "ERROR", "QUARANTINE",
         IsTimestamp("submitted_at"), "submitted_at is not a valid timestamp"),
)

# Rules that a build may add: readings with no month to count for, which the
# rule book above lets pass and the facts then leave out, and the validity of
# sites with several versions.
PERIOD_RULE = Rule("DQ010", "reading period is a month", "ERROR", "QUARANTINE", ValidPeriod(),
                   "period is not a month")
ANY_VERSION_RULE = Rule("DQ005", "reading period is within the site consolidation period", "ERROR",
                        "QUARANTINE", WithinValidity(any_version=True),
                        "reading is outside the site consolidation period")

# Lines of the readings file that are no rows of it; their rows reach no other rule.
CORRUPT_RULE = Rule("DQ000", "reading line is well-formed", "ERROR", "QUARANTINE", ValidPeriod(), "line is malformed: ")

_P = "_lk_"  # prefix of lookup columns in the enriched frame


def _w(rule: Rule, kind: str) -> str:
    return f"_w_{rule.rule_id}_{kind}"


def failure_column(rule: Rule) -> str:
    """The column of flagged rows that counts a rule's failures on the row."""
    return _w(rule, "fail")


def checked_column(rule: Rule) -> str:
    """The column that counts what a rule looked at, of rules that do not look at each row once."""
    return _w(rule, "chk")


# ----------------------------------------------------------------- execution
def flag_readings(readings: DataFrame, refs: Mapping[str, DataFrame],
                  rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Raw readings plus, per row rule, ``checked``/``failed`` weights.

    Every lookup is one row per key; reference tables that no rule reads are
    not touched.
    """
    df = readings
    merged: dict[str, KeyedAgg] = {}
    for rule in rules:
        for spec in rule.check.keyed_aggs():
            prev = merged.get(spec.name)
            aggs = dict(prev.aggs) if prev else {}
            aggs.update(dict(spec.aggs))
            merged[spec.name] = KeyedAgg(spec.table, spec.key, spec.column, tuple(aggs.items()))
    lookups = [Lookup(spec.name,
                      refs[spec.table].where(F.col(spec.key).isNotNull())
                      .groupBy(F.col(spec.key).alias("_k"))
                      .agg(*[a.alias(n) for n, a in spec.aggs]),
                      ((spec.column, "_k"),))
               for spec in merged.values()]
    for rule in rules:
        lookups += rule.check.lookups(refs)
    seen: set[str] = set()
    for lk in lookups:
        if lk.name in seen:
            continue
        seen.add(lk.name)
        cols = [c for c in lk.frame.columns if c not in {r for _, r in lk.on}]
        right = lk.frame.select(
            *[F.col(r).alias(f"{_P}{lk.name}_on_{i}") for i, (_, r) in enumerate(lk.on)],
            *[F.col(c).alias(f"{_P}{lk.name}_{c}") for c in cols])
        cond = None
        for i, (left, _) in enumerate(lk.on):
            term = df[left] == right[f"{_P}{lk.name}_on_{i}"]
            cond = term if cond is None else cond & term
        df = df.join(right, cond, "left").drop(
            *[f"{_P}{lk.name}_on_{i}" for i in range(len(lk.on))])
    parsed: dict[str, Column] = {}
    for rule in rules:
        parsed.update(rule.check.parsed())
    df = df.select("*", *[c.alias(n) for n, c in parsed.items()])
    weights = []
    for rule in rules:
        if rule.is_group_rule:
            continue
        if not rule.check.unit_checked:
            weights.append(rule.check.checked(_P).cast("int").alias(_w(rule, "chk")))
        weights.append(rule.check.failed(_P).cast("int").alias(_w(rule, "fail")))
    return df.select(*readings.columns, *weights)


def _report_rows(totals: DataFrame, rules: Sequence[Rule], order_of: Mapping[str, int]) -> DataFrame:
    rows = []
    for rule in rules:
        failed = F.col(_w(rule, "fail"))
        rows.append(F.struct(
            F.lit(order_of[rule.rule_id]).alias("_order"),
            F.lit(rule.rule_id).alias("rule_id"),
            F.lit(rule.rule_name).alias("rule_name"),
            F.lit(rule.severity).alias("severity"),
            F.col(_w(rule, "chk")).cast("bigint").alias("rows_checked"),
            failed.cast("bigint").alias("rows_failed"),
            F.when(failed > 0, F.lit(rule.action)).otherwise(F.lit("NONE")).alias("action_taken"),
        ))
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def _submissions(rows: DataFrame, keys: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Rows per submission key (combined map-side), with sums of other columns."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                   *[F.sum(c).cast("bigint").alias(c) for c in sums])


def _repeated(keys: Sequence[str]) -> Column:
    """Of a row of ``_submissions``: several rows share a key without NULLs."""
    return _not_null(keys) & (F.col("_n") > 1)


def dq_report(flagged: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """``rule_id, rule_name, severity, rows_checked, rows_failed, action_taken``.

    One scan of ``flagged``. With one group rule (the default rule book) the
    report is a two-level aggregate keyed by that rule's key; each further
    group rule adds one aggregate of its own.
    """
    order_of = {r.rule_id: i for i, r in enumerate(rules)}
    row_rules = [r for r in rules if not r.is_group_rule]
    group_rules = [r for r in rules if r.is_group_rule]
    sums = [c for r in row_rules for c in (_w(r, "chk"), _w(r, "fail"))
            if c in flagged.columns]
    unit = [_w(r, "chk") for r in row_rules if r.check.unit_checked]
    parts = []
    if group_rules:
        first = group_rules[0]
        keys = list(first.check.group_keys)
        level1 = _submissions(flagged, keys, sums)
        rows = F.coalesce(F.sum("_n"), F.lit(0))
        totals = level1.agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
            *[rows.alias(c) for c in unit],
            rows.alias(_w(first, "chk")),
            F.coalesce(F.sum(F.when(_repeated(keys), F.col("_n"))), F.lit(0))
            .alias(_w(first, "fail")))
        parts.append(_report_rows(totals, row_rules + [first], order_of))
        for rule in group_rules[1:]:
            gk = list(rule.check.group_keys)
            g = _submissions(flagged, gk).agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias(_w(rule, "chk")),
                F.coalesce(F.sum(F.when(_repeated(gk), F.col("_n"))), F.lit(0))
                .alias(_w(rule, "fail")))
            parts.append(_report_rows(g, [rule], order_of))
    else:
        rows = F.count(F.lit(1))
        totals = flagged.agg(*[F.coalesce(F.sum(c).cast("bigint"), F.lit(0)).alias(c)
                               for c in sums], *[rows.alias(c) for c in unit])
        parts.append(_report_rows(totals, row_rules, order_of))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # One row per rule: ordering them inside a single partition needs no
    # range-partitioning sample job.
    return out.coalesce(1).sortWithinPartitions("_order").drop("_order")


def dq_quarantine(flagged: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """One row per (rule, failing reading) for every rule with a reason; a
    row failing two rules appears twice. Always a typed frame, possibly
    empty, so downstream staging never depends on failures existing."""
    detail_rules = [r for r in rules if r.reason is not None and not r.is_group_rule]
    if not detail_rules:
        return flagged.select(*[F.lit(None).cast("string").alias(c)
                                for c in QUARANTINE_COLUMNS]).limit(0)
    any_fail = None
    hits = []
    for rule in detail_rules:
        n = F.col(_w(rule, "fail"))
        term = n > 0
        any_fail = term if any_fail is None else any_fail | term
        hit = F.struct(F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.reason).alias("reason"))
        hits.append(F.array_repeat(hit, n.cast("int")))
    return (flagged.where(any_fail)
            .select(*DETAIL_COLUMNS, F.explode(F.flatten(F.array(*hits))).alias("h"))
            .select(F.col("h.rule_id").alias("rule_id"),
                    *[F.col(c).cast("string").alias(c) for c in DETAIL_COLUMNS],
                    F.col("h.reason").alias("reason")))


def corrupt_quarantine(corrupt: DataFrame) -> DataFrame:
    """Malformed lines as quarantine rows: the whole line is the value."""
    none = F.lit(None).cast("string")
    return corrupt.select(F.lit(CORRUPT_RULE.rule_id).alias("rule_id"), *[none.alias(c) for c in DETAIL_COLUMNS[:-1]],
                          F.col("line").alias("value"),
                          F.concat(F.lit(CORRUPT_RULE.reason), F.lower("fault")).alias("reason"))


def corrupt_report(corrupt: DataFrame, readings: DataFrame) -> DataFrame:
    """The report row of malformed lines out of all lines."""
    counts = (corrupt.select(F.lit(1).alias("bad")).unionByName(readings.select(F.lit(0).alias("bad")))
              .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    r = CORRUPT_RULE
    return counts.select(F.lit(r.rule_id).alias("rule_id"), F.lit(r.rule_name).alias("rule_name"), F.lit(r.severity).alias("severity"),
                         F.col("n").alias("rows_checked"), F.col("bad").alias("rows_failed"),
                         F.when(F.col("bad") > 0, F.lit(r.action)).otherwise("NONE").alias("action_taken"))


def rule_failures(quarantine: DataFrame, rule_id: str) -> DataFrame:
    """Offending rows of one rule (its slice of the quarantine)."""
    return quarantine.where(F.col("rule_id") == F.lit(rule_id))


def duplicate_submissions(readings: DataFrame,
                          keys: Sequence[str] = ("site_id", "period", "metric_code")) -> DataFrame:
    """Rows of groups that share a non-NULL key with at least one other row,
    with the group size. Group sizes are combined map-side; the join back
    is a plain equi join (AQE splits a hot key)."""
    keys = list(keys)
    sizes = (_submissions(readings, keys).where(_repeated(keys))
             .withColumnRenamed("_n", "group_rows"))
    return readings.select(*DETAIL_COLUMNS).join(sizes, keys)


def dq_gate(report: DataFrame) -> DataFrame:
    """One row: how many failing rules carry the BLOCK action, and whether
    publication must stop."""
    blocking = (F.col("action_taken") == F.lit("BLOCK")) & (F.col("rows_failed") > 0)
    return report.agg(F.count_if(blocking).alias("blocking_rules"),
                      F.coalesce(F.max(blocking), F.lit(False)).alias("is_blocked"))


def has_blocking_failures(report: DataFrame) -> bool:
    return bool(dq_gate(report).first()["is_blocked"])


def own_failure(rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """Of a flagged reading: a rule with a reason failed on this very row."""
    hit = F.lit(False)
    for rule in rules:
        if rule.reason is not None and not rule.is_group_rule:
            hit = hit | (F.col(_w(rule, "fail")) > 0)
    return hit


def quarantine_exclusion(readings: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Readings whose ``reading_id`` (as submitted) is not quarantined. All
    copies of a quarantined id go; NULL ids never match and stay."""
    ids = quarantine.select(F.col("reading_id").alias("_qid")).where(
        F.col("_qid").isNotNull()).distinct()
    return readings.join(ids, readings["reading_id"] == ids["_qid"], "left_anti")


def kept_readings(flagged: DataFrame, columns: Sequence[str],
                  rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """``quarantine_exclusion`` on flagged readings: rows that fail by themselves
    go without a join; what is left is joined only to find other copies of a
    failing id."""
    own = own_failure(rules)
    failing = flagged.where(own).select("reading_id")
    rest = flagged.where(~own | F.col("reading_id").isNull()).select(*columns)
    return quarantine_exclusion(rest, failing)
