"""End-to-end build: raw -> quality -> staging -> marts -> KPIs -> reports.

``ReportingBuild`` wires the operators together lazily; each layer is a
property computed once per build. A ``materialize`` hook decides what
happens to the layers other layers share: lazily inlined (tests, the
query registry) or written as Parquet tables in a shared folder and read
back (``TableStore``), which cuts lineage, lets Spark reuse the bytes for
every consumer and survives executor loss.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import accounting, checks, conform, dims, facts, kpis, quality, versions
from ..operators.dims import ReportingWindow
from ..session import bounded_tasks, written
from ..sources.raw import CORRUPT
from ..sources.sinks import export_report

Materialize = Callable[[str, DataFrame], DataFrame]


def _lazy(name: str, df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class ReportingParams:
    window: ReportingWindow = field(default_factory=ReportingWindow)
    rules: tuple = quality.DEFAULT_RULES
    trir_basis: float = kpis.TRIR_BASIS
    rolling_months: int = kpis.ROLLING_MONTHS


class ReportingBuild:
    """All layers of one reporting build over five raw (string) tables."""

    # Layers read by more than one consumer: materialised when asked to.
    SHARED = ("dq_flags", "dq_quarantine", "stg_readings", "stg_incidents", "dim_site", "dim_metric",
              "dim_date", "fact_eqs_monthly", "fact_incident", "active_spine",
              *checks.KPI_CONTRACT)

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame],
                 params: ReportingParams | None = None,
                 materialize: Materialize = _lazy):
        self.spark = spark
        self.raw = dict(raw)
        self.params = params or ReportingParams()
        self.store: TableStore | None = None
        self._materialize = materialize
        bounded_tasks(spark, self.raw["readings"], self.raw["incidents"])

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self.SHARED:
            return df
        return self._materialize(name, df)

    # ------------------------------------------------------------ quality
    @cached_property
    def flagged(self) -> DataFrame:
        """Raw readings with every rule's weights: the one pass over the
        largest input; report, quarantine and staging all read it."""
        return self._keep("dq_flags", quality.flag_readings(
            self.raw["readings"], self.raw, self.params.rules))

    @cached_property
    def corrupt(self) -> DataFrame | None:
        """Malformed lines of the readings file, where the raw tables come with them."""
        lines = self.raw.get(CORRUPT)
        return None if lines is None else lines.where(F.col("table_name") == "readings")

    @cached_property
    def dq_report(self) -> DataFrame:
        report = quality.dq_report(self.flagged, self.params.rules)
        if self.corrupt is None:
            return report
        return quality.corrupt_report(self.corrupt, self.raw["readings"]).unionByName(report)

    @cached_property
    def dq_quarantine(self) -> DataFrame:
        rows = quality.dq_quarantine(self.flagged, self.params.rules)
        if self.corrupt is not None:
            rows = rows.unionByName(quality.corrupt_quarantine(self.corrupt))
        return self._keep("dq_quarantine", rows)

    @cached_property
    def kept_readings(self) -> DataFrame:
        return quality.kept_readings(self.flagged, self.raw["readings"].columns, self.params.rules)

    # ------------------------------------------------------------ staging
    @cached_property
    def stg_sites(self) -> DataFrame:
        return conform.conform_sites(self.raw["sites"])

    @cached_property
    def stg_metrics(self) -> DataFrame:
        return conform.conform_metrics(self.raw["metric_definitions"])

    @cached_property
    def stg_uom(self) -> DataFrame:
        return conform.conform_uom(self.raw["uom_conversions"])

    @cached_property
    def typed_readings(self) -> DataFrame:
        return conform.typed_readings(self.kept_readings)

    @cached_property
    def in_canonical_units(self) -> DataFrame:
        return conform.canonical_units(self.typed_readings, self.stg_metrics, self.stg_uom)

    @cached_property
    def stg_readings(self) -> DataFrame:
        return self._keep("stg_readings", conform.latest_submission(self.in_canonical_units))

    @cached_property
    def typed_incidents(self) -> DataFrame:
        return conform.typed_incidents(self.raw["incidents"])

    @cached_property
    def stg_incidents(self) -> DataFrame:
        return self._keep("stg_incidents", conform.dedupe_priority(self.typed_incidents))

    # --------------------------------------------------------------- marts
    @cached_property
    def dim_site(self) -> DataFrame:
        return self._keep("dim_site", dims.dim_site(self.stg_sites))

    @cached_property
    def dim_metric(self) -> DataFrame:
        return self._keep("dim_metric", dims.dim_metric(self.stg_metrics))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._keep("dim_date", dims.dim_date(
            dims.window_bounds(self.spark, self.params.window)))

    @cached_property
    def monthly_values(self) -> DataFrame:
        return facts.monthly_values(self.stg_readings)

    @cached_property
    def fact_monthly(self) -> DataFrame:
        return self._keep("fact_eqs_monthly", facts.fact_monthly(
            self.monthly_values, self.dim_site, self.dim_date, self.dim_metric))

    @cached_property
    def fact_incident(self) -> DataFrame:
        return self._keep("fact_incident", facts.fact_incident(
            self.stg_incidents, self.dim_site, self.dim_date))

    # ---------------------------------------------------------------- KPIs
    @cached_property
    def active_spine(self) -> DataFrame:
        return self._keep("active_spine", kpis.active_spine(
            self.dim_site, self.dim_date, self.params.window))

    @cached_property
    def kpi_emissions(self) -> DataFrame:
        return self._keep("kpi_emissions", kpis.kpi_emissions(
            self.active_spine, self.fact_monthly, self.dim_metric))

    @cached_property
    def kpi_energy_intensity(self) -> DataFrame:
        return self._keep("kpi_energy_intensity", kpis.kpi_energy_intensity(
            self.active_spine, self.fact_monthly, self.dim_metric))

    @cached_property
    def monthly_recordables(self) -> DataFrame:
        return kpis.monthly_recordables(self.fact_incident)

    @cached_property
    def hours_by_month(self) -> DataFrame:
        return kpis.hours_by_month(self.fact_monthly, self.dim_metric)

    @cached_property
    def rolling_12m(self) -> DataFrame:
        return kpis.rolling_12m(self.active_spine, self.monthly_recordables,
                                self.hours_by_month, self.params.rolling_months)

    @cached_property
    def kpi_trir(self) -> DataFrame:
        return self._keep("kpi_trir", kpis.kpi_trir(
            self.rolling_12m, self.params.trir_basis, self.params.rolling_months))

    @cached_property
    def yoy_rollup(self) -> DataFrame:
        return kpis.two_level_rollup(self.kpi_emissions)

    @cached_property
    def kpi_yoy(self) -> DataFrame:
        return self._keep("kpi_yoy", kpis.kpi_yoy(self.yoy_rollup))

    # ---------------------------------------------------------- accounting
    @cached_property
    def row_ledger(self) -> DataFrame:
        """The end of every raw reading and incident (``accounting``)."""
        def numbered(rows: DataFrame, name: str) -> DataFrame:
            return written(rows.withColumn(accounting.ROW, F.monotonically_increasing_id()), f"numbered-{name}")

        # numbered when they are written, so that nothing that is run again can change a number
        flagged = numbered(quality.flag_readings(self.raw["readings"], self.raw, self.params.rules), "readings")
        readings = accounting.reading_ends(flagged, self.raw["readings"].columns, self.params.rules, self.stg_metrics,
                                           self.stg_uom, self.dim_site, self.dim_date, self.dim_metric)
        return readings.unionByName(accounting.incident_ends(numbered(self.raw["incidents"], "incidents"), self.dim_site, self.dim_date))

    @cached_property
    def row_accounting(self) -> DataFrame:
        return accounting.row_accounting(self.row_ledger)

    @cached_property
    def kpi_like_for_like(self) -> DataFrame:
        return kpis.like_for_like(self.kpi_emissions)

    @cached_property
    def version_conflicts(self) -> DataFrame:
        """Overlaps and holes of site versions by day, and overlaps by month, in which the
        monthly fact would take a reading twice."""
        by_month = versions.version_conflicts(self.stg_sites, "site_id", month=True).where(F.col("kind") == versions.OVERLAP)
        return (versions.version_conflicts(self.stg_sites, "site_id").withColumn("grain", F.lit("DAY"))
                .unionByName(by_month.withColumn("grain", F.lit("MONTH"))).withColumnRenamed("key", "site_id"))

    # ------------------------------------------------------------- outputs
    def dims(self) -> list[DataFrame]:
        """The dimensions, which do not need one another: their small jobs run side by side."""
        with ThreadPoolExecutor(3) as pool:
            made = [pool.submit(getattr, self, name) for name in ("dim_site", "dim_metric", "dim_date")]
        return [m.result() for m in made]

    def marts(self) -> dict[str, DataFrame]:
        """The marts under their contract names (``checks.REQUIRED_MARTS``)."""
        self.dims()
        return {"dim_site": self.dim_site, "dim_metric": self.dim_metric,
                "dim_date": self.dim_date, "fact_eqs_monthly": self.fact_monthly,
                "fact_incident": self.fact_incident}

    def kpi_tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in checks.KPI_CONTRACT}

    def validate_columns(self) -> None:
        """KPI and report columns in contract order."""
        for name, cols in checks.KPI_CONTRACT.items():
            checks.check_columns(self.kpi_tables()[name], cols, name)
        checks.check_columns(self.dq_report, checks.DQ_REPORT_COLUMNS, "dq_report")

    def data_checks(self) -> dict[str, DataFrame]:
        """The data part of the contract, one small frame per check."""
        marts, w = self.marts(), self.params.window
        fact, incident = marts["fact_eqs_monthly"], marts["fact_incident"]
        return {
            "check_unique": checks.check_unique([
                ("dim_site", self.dim_site, ["site_key"]),
                ("dim_metric", self.dim_metric, ["metric_key"]),
                ("dim_date", self.dim_date, ["date_key"]),
                ("fact_eqs_monthly", fact, ["site_key", "date_key", "metric_key"]),
                ("fact_incident", incident, ["incident_id"])]),
            "check_orphans": checks.check_orphans([
                ("fact_eqs_monthly", fact, self.dim_site, "site_key"),
                ("fact_eqs_monthly", fact, self.dim_metric, "metric_key"),
                ("fact_eqs_monthly", fact, self.dim_date, "date_key"),
                ("fact_incident", incident, self.dim_site, "site_key"),
                ("fact_incident", incident, self.dim_date, "date_key")]),
            "check_ranges": checks.check_ranges({**marts, **self.kpi_tables()}, w.start,
                                                w.last_month.strftime("%Y-%m")),
            "check_dq_report": checks.check_dq_report(self.dq_report),
            "check_versions": self.version_conflicts,
        }


# Tables that are cut into parts by month, and the column that names it. The column
# stays in the files; the folders are named by a copy of it.
PARTED = {"fact_eqs_monthly": "date_key", "fact_incident": "date_key", "kpi_emissions": "period",
          "kpi_energy_intensity": "period", "kpi_trir": "period", "kpi_yoy": "period"}
PART = "_part"


class TableStore:
    """Materialise layers as Parquet tables under one (shared) folder; with ``parted``
    the PARTED ones are cut by month."""

    def __init__(self, spark: SparkSession, root: str, parted: bool = False):
        self.spark = spark
        self.parted = parted
        self.root = root.rstrip("/")
        self.written: dict[str, str] = {}
        self.schemas: dict[str, StructType] = {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        if self.parted and name in PARTED:
            # a month's rows meet in few tasks, and a large month in as many as it takes
            rows = df.withColumn(PART, F.col(PARTED[name]).cast("string")).hint("rebalance", PART)
            rows.write.mode("overwrite").partitionBy(PART).parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
        self.written[name], self.schemas[name] = path, df.schema
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def present(self, names: Sequence[str]) -> dict[str, DataFrame]:
        """Those of the named tables that this store has written and that can be read."""
        found = {}
        for name in names:
            try:
                if name in self.written:
                    schema = self.schemas[name]
                    found[name] = self.spark.read.schema(schema).parquet(self.written[name]).select(*schema.names)
            except AnalysisException:  # no such folder
                continue
        return found


# Sort keys for the published reports (the contract's natural order).
REPORT_ORDER = {
    "kpi_emissions": ["period", "site_id"],
    "kpi_energy_intensity": ["period", "site_id"],
    "kpi_trir": ["period", "site_id"],
    "kpi_yoy": ["period", "grouping_level", "grouping_value"],
}


class PublicationBlocked(RuntimeError):
    """A failing rule with the BLOCK action stops the reports."""


def run_pipeline(spark: SparkSession, raw: Mapping[str, DataFrame], out_dir: str,
                 params: ReportingParams | None = None, gate: bool = False,
                 parted: bool = False) -> ReportingBuild:
    """Build every layer, write marts, KPIs and contract checks as Parquet and the
    five reports as CSV under ``out_dir``; return the build (layers read back).

    The quality report comes first and is written whatever follows. With ``gate`` a
    failing rule with the BLOCK action then ends the build, before a mart or KPI is
    made. A required table that this run has not written, a duplicated key or an
    orphaned fact row is an error before any KPI report is written; the other checks are
    written for the reader. With ``parted`` facts and KPIs are cut by month. ``publish.publish_build`` makes a build visible as a whole."""
    store = TableStore(spark, f"{out_dir.rstrip('/')}/tables", parted)
    reports = f"{out_dir.rstrip('/')}/reports"
    build = ReportingBuild(spark, raw, params, materialize=store)
    build.store = store
    report = store("dq_report", build.dq_report)
    export_report(report, checks.DQ_REPORT_COLUMNS, f"{reports}/dq_report", ["rule_id"])
    if gate and quality.has_blocking_failures(report):
        raise PublicationBlocked("a blocking rule failed; see the quality report")
    build.validate_columns()
    build.marts()
    _ = build.dq_quarantine  # written for the reader; nothing below needs it
    required = [*checks.REQUIRED_MARTS, *checks.KPI_CONTRACT]
    checks.check_required(store.present(required), required)
    found = {name: store(name, df) for name, df in build.data_checks().items()}
    bad = [r.asDict() for r in found["check_unique"].where("duplicate_keys > 0").collect()]
    bad += [r.asDict() for r in found["check_orphans"].where("orphan_rows > 0").collect()]
    if bad:
        raise checks.ContractError(f"keys do not hold: {bad}")
    for name, cols in checks.KPI_CONTRACT.items():
        export_report(getattr(build, name), cols, f"{reports}/{name}", REPORT_ORDER[name])
    return build
