"""Incremental build: from the changes between two raw snapshots to the months they touch.

A changed reading can change the cell (site, month, metric) it was sent for, and the
cells of other readings that share its id, as quarantine goes by id. A cell feeds its
month and, reported by quarter, the two before it; a month's hours and incidents feed
twelve months of the rolling rate, and its emissions the month one year on. These months
are computed again from the new snapshot and from what is published of the other
months, and only they are written. A change of a catalogue (sites, metrics, units)
renumbers keys and can reach every month, so it is a full build.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, conform, facts, kpis, quality
from ..operators.changes import DELTA, changed_rows
from ..session import written
from .pipeline import PART, PARTED, PublicationBlocked, ReportingParams
from .publish import Manifest, Publication, publish_build

CATALOGUES = ("sites", "metric_definitions", "uom_conversions")
CELL = ["site_id", "period_start", "metric_code"]
YEAR = 12


@dataclass(frozen=True)
class Update:
    """The new content of a table's touched parts; ``parts`` None: of the whole table."""
    parts: list[str] | None
    rows: DataFrame


# ---------------------------------------------------------------- change sets
def _months_after(cells: DataFrame, month: str, offsets: Sequence[int]) -> DataFrame:
    """``cells`` with their month moved by each offset."""
    moved = F.explode(F.transform(F.array(*map(F.lit, offsets)), lambda k: F.add_months(month, k)))
    return cells.select(*[c for c in cells.columns if c != month], moved.alias(month)).distinct()


def _of_ids(snapshots: Sequence[DataFrame], changes: DataFrame) -> DataFrame:
    """Rows of the snapshots that share an id with a changed one, and changed rows without an id."""
    ids = changes.where("reading_id IS NOT NULL").select("reading_id").distinct()
    parts = [s.join(ids, "reading_id", "left_semi") for s in snapshots]
    parts.append(changes.where("reading_id IS NULL").select(*snapshots[0].columns))
    return reduce(DataFrame.unionByName, parts)


def touched_cells(old: DataFrame, new: DataFrame, changes: DataFrame) -> DataFrame:
    """(site_id, period_start, metric_code) of all readings whose fate the changes may alter.
    Cells without a site, a month or a metric reach no fact."""
    typed = conform.typed_readings(_of_ids([old, new], changes))
    return typed.select(*CELL).dropna().distinct()


def readings_of(new: DataFrame, cells: DataFrame) -> DataFrame:
    """The raw readings of ``cells``, and all others that share an id with one of them."""
    typed = conform.typed_readings(new.select(*new.columns, F.struct(*new.columns).alias("_raw")), carry=["_raw"])
    own = typed.join(cells, CELL, "left_semi").select("_raw.*")
    return _of_ids([new], own)


# ------------------------------------------------------------ quality, by change
def _report_counts(flagged: DataFrame, rules: Sequence[quality.Rule]) -> DataFrame:
    """(rule_id, checked, failed) that changed rows add to the rules that ask one row."""
    own = [r for r in rules if not r.is_group_rule]
    d = F.col(DELTA)
    entries = [F.struct(
        F.lit(r.rule_id).alias("rule_id"),
        F.coalesce(F.sum(d * (F.lit(1) if r.check.unit_checked else F.col(quality.checked_column(r)))), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(d * F.col(quality.failure_column(r))), F.lit(0)).alias("failed")) for r in own]
    totals = flagged.agg(F.array(*entries).alias("e"))
    return totals.select(F.explode("e").alias("e")).select("e.*")


def _group_counts(old: DataFrame, new: DataFrame, changes: DataFrame, rule: quality.Rule) -> DataFrame:
    """The same of a rule on repeated keys: groups that a change is in, before and after."""
    keys = list(rule.check.group_keys)
    touched = changes.select(*keys).dropna().distinct()

    def repeated(df: DataFrame, sign: int) -> DataFrame:
        groups = df.join(touched, keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        return groups.where("n > 1").select((F.col("n") * sign).alias("failed"), F.lit(0).cast("bigint").alias("checked"))

    rows = (repeated(old, -1).unionByName(repeated(new, 1))
            .unionByName(changes.select(F.lit(0).cast("bigint").alias("failed"), F.col(DELTA).alias("checked"))))
    return rows.agg(F.coalesce(F.sum("checked"), F.lit(0)).alias("checked"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failed")
                    ).select(F.lit(rule.rule_id).alias("rule_id"), "checked", "failed")


def updated_report(report: DataFrame, old: DataFrame, new: DataFrame, changes: DataFrame, flagged: DataFrame,
                   rules: Sequence[quality.Rule]) -> DataFrame:
    """The quality report of the new snapshot out of the one before and the changed rows."""
    parts = [_report_counts(flagged, rules)] + [_group_counts(old, new, changes, r) for r in rules if r.is_group_rule]
    change = reduce(DataFrame.unionByName, parts)
    actions = F.coalesce(*[F.when(F.col("rule_id") == r.rule_id, F.lit(r.action)) for r in rules])
    failed = F.col("rows_failed") + F.col("failed")
    return report.join(change, "rule_id").select(
        "rule_id", "rule_name", "severity", (F.col("rows_checked") + F.col("checked")).cast("bigint").alias("rows_checked"),
        failed.cast("bigint").alias("rows_failed"), F.when(failed > 0, actions).otherwise("NONE").alias("action_taken"))


# ------------------------------------------------------------------- the build
def _index(part: str) -> int:
    """The number of a month from its part: YYYYMM or YYYY-MM."""
    digits = part.replace("-", "")
    return int(digits[:4]) * 12 + int(digits[4:]) - 1


def _name(index: int, dash: str = "-") -> str:
    return f"{index // 12:04d}{dash}{index % 12 + 1:02d}"


def _parts(df: DataFrame, column: str) -> set[int]:
    """The touched months: no more than the reporting window has."""
    return {_index(str(r[0])) for r in df.select(column).distinct().collect()}


def _with_new(published: DataFrame, column: str, months: Sequence[int], dash: str, new: DataFrame) -> DataFrame:
    """A published table in which the rows of ``months`` are replaced."""
    names = [_name(m, dash) for m in months]
    return published.where(~F.col(column).cast("string").isin(*names)).unionByName(new)


def incremental_update(old: Mapping[str, DataFrame], new: Mapping[str, DataFrame], base: Mapping[str, DataFrame],
                       params: ReportingParams | None = None) -> dict[str, Update] | None:
    """What has to be written to get from the tables ``base`` of the snapshot ``old`` to those
    of ``new``, by table; None where a catalogue changed, which takes a full build.

    ``base`` holds the marts, the KPIs, the quality report and the quarantine as a full
    build of ``old`` with the same parameters gives them."""
    params = params or ReportingParams()
    if any(not changed_rows(old[c], new[c]).isEmpty() for c in CATALOGUES):
        return None
    rules, columns = params.rules, new["readings"].columns
    site, date, metric = base["dim_site"], base["dim_date"], base["dim_metric"]
    window = {params.window.first_month.year * 12 + params.window.first_month.month - 1 + k for k in range(params.window.months)}
    out: dict[str, Update] = {}

    # quality: changed rows only
    changes = written(changed_rows(old["readings"], new["readings"]), "changed-readings")
    flagged = written(quality.flag_readings(changes, new, rules), "changed-flags")
    out["dq_report"] = Update(None, updated_report(base["dq_report"], old["readings"], new["readings"], changes, flagged, rules))
    gone, come = (flagged.where(F.col(DELTA) * s > 0).withColumn("_k", F.explode(F.sequence(F.lit(1), F.col(DELTA).cast("int") * s)))
                  for s in (-1, 1))
    out["dq_quarantine"] = Update(None, base["dq_quarantine"].exceptAll(quality.dq_quarantine(gone, rules))
                                  .unionByName(quality.dq_quarantine(come, rules)))

    # facts: the months that changed cells feed, out of all the cells that feed these
    cells = written(touched_cells(old["readings"], new["readings"], changes), "touched-cells")
    fed = _months_after(cells, "period_start", [-k for k in range(facts.QUARTER_MONTHS)]).withColumnRenamed("period_start", "value_month")
    fed = written(fed, "fed-cells")
    feeding = _months_after(fed, "value_month", range(facts.QUARTER_MONTHS)).withColumnRenamed("value_month", "period_start")
    feeding = written(feeding.select(*CELL), "feeding-cells")
    flags = written(quality.flag_readings(readings_of(new["readings"], feeding), new, rules), "touched-flags")
    typed = conform.typed_readings(quality.kept_readings(flags, columns, rules)).join(feeding, CELL, "left_semi")
    converted = conform.canonical_units(typed, conform.conform_metrics(new["metric_definitions"]), conform.conform_uom(new["uom_conversions"]))
    values = facts.monthly_values(conform.latest_submission(converted)).join(fed, ["site_id", "value_month", "metric_code"], "left_semi")
    made = written(facts.fact_monthly(values, site, date, metric), "new-facts")
    keys = written(fed.join(site.select("site_id", "site_key"), "site_id")
                   .join(date.select(F.col("month_start").alias("value_month"), "date_key"), "value_month")
                   .join(metric.select("metric_code", "metric_key"), "metric_code")
                   .select("site_key", "date_key", "metric_key").distinct(), "fed-keys")
    fact = base["fact_eqs_monthly"]
    replaced = fact.join(keys, ["site_key", "date_key", "metric_key"], "left_semi")
    months = sorted((_parts(made, "date_key") | _parts(replaced, "date_key")) & window)
    kept = fact.where(F.col("date_key").isin([int(_name(m, "")) for m in months])).join(
        keys, ["site_key", "date_key", "metric_key"], "left_anti")
    fact_rows = written(kept.select(*made.columns).unionByName(made), "touched-facts")
    out["fact_eqs_monthly"] = Update([_name(m, "") for m in months], fact_rows)
    fact = _with_new(fact, "date_key", months, "", fact_rows)

    # incidents: by id
    changed = conform.typed_incidents(changed_rows(old["incidents"], new["incidents"])).select("incident_id").distinct()
    changed = written(changed, "changed-incidents").withColumnRenamed("incident_id", "_id")

    def of_changed(df: DataFrame, how: str) -> DataFrame:
        return df.join(changed, F.col("incident_id").eqNullSafe(F.col("_id")), how)

    incidents = conform.dedupe_priority(of_changed(conform.typed_incidents(new["incidents"]), "left_semi"))
    made = written(facts.fact_incident(incidents, site, date), "new-incidents")
    incident = base["fact_incident"]
    hit = sorted(_parts(made, "date_key") | _parts(of_changed(incident, "left_semi"), "date_key"))
    kept = of_changed(incident.where(F.col("date_key").isin([int(_name(m, "")) for m in hit])), "left_anti")
    incident_rows = written(kept.select(*made.columns).unionByName(made), "touched-incidents")
    out["fact_incident"] = Update([_name(m, "") for m in hit], incident_rows)
    incident = _with_new(incident, "date_key", hit, "", incident_rows)

    # KPIs of these months, of the rolling months after them and of the year after them
    spine = kpis.active_spine(site, date, params.window)

    def of(df: DataFrame, which: set[int] | Sequence[int], column: str = "period") -> DataFrame:
        dash = "-" if column == "period" else ""
        return df.where(F.col(column).cast("string").isin([_name(m, dash) for m in sorted(which)]))

    for name in ("kpi_emissions", "kpi_energy_intensity"):
        rows = getattr(kpis, name)(of(spine, months), of(fact, months, "date_key"), metric)
        out[name] = Update([_name(m) for m in months], written(rows, name))
    rolling = sorted({m + k for m in {*months, *hit} for k in range(params.rolling_months)} & window)
    read = range(rolling[0] - params.rolling_months + 1, rolling[-1] + 1) if rolling else ()
    trir = kpis.kpi_trir(
        kpis.rolling_12m(of(spine, read), kpis.monthly_recordables(of(incident, read, "date_key")),
                         kpis.hours_by_month(of(fact, read, "date_key"), metric), params.rolling_months),
        params.trir_basis, params.rolling_months)
    out["kpi_trir"] = Update([_name(m) for m in rolling], written(of(trir, rolling), "kpi_trir"))
    years = sorted({m + k for m in months for k in (0, YEAR)} & window)
    emissions = _with_new(base["kpi_emissions"], "period", months, "-", out["kpi_emissions"].rows)
    yoy = kpis.kpi_yoy(kpis.two_level_rollup(of(emissions, {m - k for m in years for k in (0, YEAR)})))
    out["kpi_yoy"] = Update([_name(m) for m in years], written(of(yoy, years), "kpi_yoy"))
    return out


def applied(base: DataFrame, update: Update, name: str) -> DataFrame:
    """A table of the new snapshot: the parts of ``base`` that are left, and the new ones."""
    if update.parts is None:
        return update.rows
    return base.where(~F.col(PARTED[name]).cast("string").isin(update.parts)).unionByName(update.rows)


def publish_increment(spark: SparkSession, old: Mapping[str, DataFrame], new: Mapping[str, DataFrame], root: str,
                      params: ReportingParams | None = None, gate: bool = False) -> Manifest:
    """Publish the tables of ``new`` as the version after the latest one, which was built from
    ``old``: touched parts are written, all others stay where the last version has them.

    Duplicated keys and orphans are looked for in the touched parts; these, or with
    ``gate`` a blocking rule, raise, and nothing is published. After a change of a
    catalogue everything is built anew."""
    published = Publication(spark, root)
    last = published.manifest()
    base = {name: published.read(last, name) for name in last.tables}
    updates = incremental_update(old, new, base, params)
    if updates is None:
        return publish_build(spark, new, root, params, gate)
    report = written(updates["dq_report"].rows, "dq-report")
    if gate and quality.has_blocking_failures(report):
        raise PublicationBlocked("a blocking rule failed; nothing was published")
    _check_touched(updates, base)
    folder = published.new_folder()
    tables = {name: dict(parts) for name, parts in last.tables.items() if name in (*base_names(), *updates)}
    for name, update in updates.items():
        path = f"{folder}/tables/{name}"
        rows = (report if name == "dq_report" else update.rows).select(*base[name].columns)
        if update.parts is None:
            rows.write.parquet(path)
            tables[name] = {"": path}
        elif update.parts:
            cut = rows.withColumn(PART, F.col(PARTED[name]).cast("string")).hint("rebalance", PART)
            cut.write.partitionBy(PART).parquet(path)
            rest = {p: f for p, f in tables[name].items() if p not in update.parts}
            tables[name] = rest | published.parts_of(name, path)
    return published.commit(folder.rpartition("/")[2], tables, {n: base[n].schema for n in tables}, last.version)


def base_names() -> list[str]:
    """The tables that an increment takes over from the version before."""
    return [*checks.REQUIRED_MARTS, *checks.KPI_CONTRACT]


def _check_touched(updates: Mapping[str, Update], base: Mapping[str, DataFrame]) -> None:
    fact, incident = updates["fact_eqs_monthly"].rows, updates["fact_incident"].rows
    found = checks.check_unique([("fact_eqs_monthly", fact, ["site_key", "date_key", "metric_key"]),
                                 ("fact_incident", incident, ["incident_id"])])
    bad: list[dict] = [r.asDict() for r in found.where("duplicate_keys > 0").collect()]
    orphans = checks.check_orphans([(n, f, base[d], k) for n, f in (("fact_eqs_monthly", fact), ("fact_incident", incident))
                                    for d, k in (("dim_site", "site_key"), ("dim_date", "date_key"))])
    bad += [r.asDict() for r in orphans.where("orphan_rows > 0").collect()]
    if bad:
        raise checks.ContractError(f"keys do not hold in the touched parts: {bad}")
