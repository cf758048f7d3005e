"""Query registry: one callable per operator, over the driver's tables.

Every entry takes ``(spark, sf_dir)``, derives the five raw tables from the
TPC-H style tables with the deterministic adapter, runs the operator on
them and returns a DataFrame. Doubles are rounded to 6 decimals (as
``round(x * 1e6) / 1e6``, which both engines evaluate bit-identically) so
the oracle comparison does not trip over summation order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import changes, checks, dims, facts, kpis, quality, rulebooks, versions
from ..operators.dims import ReportingWindow
from ..session import scratch_path, written
from ..sources import adapter
from ..sources.raw import RAW_COLUMNS, ingest_raw, ingest_with_corrupt, source_counts
from ..streaming import submissions
from .incremental import publish_increment
from .pipeline import ReportingBuild, ReportingParams
from .publish import Publication, publish_build

ADAPTER_PARAMS = ReportingParams(window=ReportingWindow(*adapter.ADAPTER_WINDOW))

# The rule that the gate query makes a blocking one.
BLOCKING_RULE = "DQ001"

Query = Callable[[SparkSession, str], DataFrame]


def stable(df: DataFrame) -> DataFrame:
    """Round every double column to 6 decimals, engine-independently."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append((F.round(F.col(f.name) * F.lit(1e6)) / F.lit(1e6)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def build(spark: SparkSession, sf_dir: str) -> ReportingBuild:
    return ReportingBuild(spark, adapter.raw_tables(spark, sf_dir), ADAPTER_PARAMS)


def _layer(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return stable(getattr(build(spark, sf_dir), name))
    run.__name__ = name
    return run


def _rule(rule_id: str) -> Query:
    """Rows that one rule of the book quarantines; only what it asks about is joined."""
    return _one_rule(next(r for r in quality.DEFAULT_RULES if r.rule_id == rule_id))


def q_ingest_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round-trip the adapted readings through a CSV file with a header and
    read them back as all-string columns. The copy goes when the application
    ends."""
    readings = adapter.raw_tables(spark, sf_dir)["readings"]
    path = scratch_path(spark, "ingest-readings")
    (readings.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return ingest_raw(spark, path, RAW_COLUMNS["readings"])


def q_corrupt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed lines of a readings file, found again with what is wrong with them."""
    path = scratch_path(spark, "ingest-lines")
    columns = RAW_COLUMNS["readings"]
    line = adapter.damaged_lines(adapter.raw_tables(spark, sf_dir)["readings"])
    # one column, named by the header and never quoted, so that lines stand as they are
    line.select(F.col("line").alias(",".join(columns))).write.option("header", True).option("sep", "\u0001").option(
        "quote", "\u0000").csv(path)
    rows, bad = ingest_with_corrupt(spark, path, columns, "readings")
    well = rows.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("readings").alias("table_name"), F.lit(None).cast("string").alias("fault"), F.lit(len(columns)).alias("fields"),
        F.col("n").cast("string").alias("line"))
    return bad.unionByName(well)


def q_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_counts(adapter.raw_tables(spark, sf_dir))


def q_dq_multiple_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_submissions(adapter.raw_tables(spark, sf_dir)["readings"])


def q_dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate of a rule book in which numeric values are a blocking rule."""
    rules = tuple(replace(r, action="BLOCK") if r.rule_id == BLOCKING_RULE else r
                  for r in quality.DEFAULT_RULES)
    return quality.dq_gate(_with_rules(spark, sf_dir, rules).dq_report)


def _with_rules(spark: SparkSession, sf_dir: str, rules: tuple) -> ReportingBuild:
    return ReportingBuild(spark, adapter.raw_tables(spark, sf_dir), replace(ADAPTER_PARAMS, rules=rules))


def _one_rule(rule: quality.Rule) -> Query:
    """Rows that one rule quarantines, the rule alone being the book."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _with_rules(spark, sf_dir, (rule,)).dq_quarantine
    return run


def q_quarterly_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable(facts.quarterly_allocation(build(spark, sf_dir).stg_readings))


def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month spine of the reporting window derived from the data: the last
    ``months`` months ending with the last complete calendar year of orders."""
    orders = adapter.read_table(spark, sf_dir, "orders")
    return dims.dim_date(dims.bounds_to_last_full_year(orders, "o_orderdate",
                                                       ADAPTER_PARAMS.window.months))


def q_metric_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    return stable(kpis.metric_pivot(
        b.fact_monthly, b.dim_metric,
        [("ENERGY_CONS", "energy_mwh"), ("HOURS_WORKED", "hours_worked")],
        [("HOURS_WORKED", "is_estimated", "hours_allocated")]))


def q_strict_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    return stable(kpis.strict_rollup(b.kpi_emissions, ["period", "business_unit"],
                                     "total_tco2e"))


def q_rolling_12m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable(build(spark, sf_dir).rolling_12m)


def q_check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir).data_checks()["check_unique"]


def q_check_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The build's checks, and raw readings against their catalogues, where there
    are orphans to be found."""
    b = build(spark, sf_dir)
    raw = checks.check_orphans([
        ("raw_readings", b.raw["readings"], b.raw["sites"], "site_id"),
        ("raw_readings", b.raw["readings"], b.raw["metric_definitions"], "metric_code")])
    return b.data_checks()["check_orphans"].unionByName(raw)


def q_check_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable(build(spark, sf_dir).data_checks()["check_ranges"])


def q_check_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir).data_checks()["check_dq_report"]


def q_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the whole build and count what a reader of its manifest finds."""
    root = scratch_path(spark, "publication")
    made = publish_build(spark, adapter.raw_tables(spark, sf_dir), root, ADAPTER_PARAMS)
    reader = Publication(spark, root)
    manifest = reader.manifest()
    found = [reader.read(manifest, name).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), F.lit(made.version).alias("version"), "row_count",
        F.lit(len(manifest.tables[name])).alias("parts")) for name in [*checks.REQUIRED_MARTS, *checks.KPI_CONTRACT]]
    return reduce(DataFrame.unionByName, found)


#: Keys and measures of the KPIs, as the ledger and the long form hold them.
KPI_KEYS = {"kpi_emissions": ["period", "site_id"], "kpi_energy_intensity": ["period", "site_id"],
            "kpi_trir": ["period", "site_id"], "kpi_yoy": ["period", "grouping_level", "grouping_value"]}
KPI_MEASURES = {
    "kpi_emissions": ["scope1_tco2e", "scope2_tco2e", "total_tco2e"],
    "kpi_energy_intensity": ["energy_mwh", "hours_worked", "mwh_per_1000_hours"],
    "kpi_trir": ["recordable_incidents_r12", "hours_worked_r12", "trir_r12"],
    "kpi_yoy": ["total_tco2e", "total_tco2e_ly", "yoy_abs", "yoy_pct"]}


def _entity(name: str) -> Column:
    """Whom a KPI row is about, as one text."""
    rest = KPI_KEYS[name][1:]
    return F.concat_ws(":", *rest).alias("entity")


def q_incremental_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All KPI values after a round of corrections, published as an increment to the build
    before them: whatever the way, they are those of a full build."""
    raw = adapter.raw_tables(spark, sf_dir)
    before, root = adapter.before_corrections(raw), scratch_path(spark, "increments")
    publish_build(spark, before, root, ADAPTER_PARAMS)
    manifest = publish_increment(spark, before, raw, root, ADAPTER_PARAMS)
    reader = Publication(spark, root)
    found = [changes.long_values(reader.read(manifest, name).select("period", _entity(name), *measures), ["period", "entity"], measures)
             .select(F.lit(name).alias("kpi"), "period", "entity", "measure", "value") for name, measures in KPI_MEASURES.items()]
    return stable(reduce(DataFrame.unionByName, found))


def q_restatement_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the KPIs published today restate of those published at the end of June 2000."""
    raw = adapter.raw_tables(spark, sf_dir)
    then, now = (ReportingBuild(spark, r, ADAPTER_PARAMS) for r in (adapter.as_known(raw), raw))
    found = [changes.restatement_ledger(stable(getattr(then, name)), stable(getattr(now, name)), keys, KPI_MEASURES[name])
             .select(F.lit(name).alias("kpi"), "period", _entity(name), "measure", "kind", "old_value", "new_value")
             for name, keys in KPI_KEYS.items()]
    return reduce(DataFrame.unionByName, found)


def q_dq_report_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rulebooks.report_of_sources(adapter.raw_tables(spark, sf_dir))


def q_dq_quarantine_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rulebooks.quarantine_of_sources(adapter.raw_tables(spark, sf_dir))


def _contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions of what holds for a customer: some end, some are open."""
    return adapter.adapt_contracts(adapter.read_table(spark, sf_dir, "orders"))


def q_version_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.version_conflicts(_contracts(spark, sf_dir), "customer")


def q_covered_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.covered_spans(_contracts(spark, sf_dir), "customer")


def q_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order that held for a customer when each event of that customer came in."""
    asked = adapter.read_table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("customer"), "ts")
    known = adapter.read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer"), F.col("o_orderdate").alias("since"), F.col("o_orderkey").alias("order"))
    return versions.as_of(asked, known, "customer", "ts", "since", "order")


def q_event_time_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest submission per user and type over a stream of batches, and what came too late."""
    rows = written(adapter.event_batches(adapter.read_table(spark, sf_dir, "events")), "event-batches")
    landing, out, key = scratch_path(spark, "events-landing"), scratch_path(spark, "events-out"), ["user_id", "event_type"]
    for k in range(adapter.EVENT_BATCHES):  # a batch after the other, as they come in
        rows.where(F.col("batch") == k).drop("batch").repartition(adapter.BATCH_FILES).write.parquet(f"{landing}/in{k}")
    stream = (spark.readStream.schema(rows.drop("batch").schema).option("maxFilesPerTrigger", adapter.BATCH_FILES)
              .parquet(f"{landing}/in*"))
    submissions.start(stream, key, adapter.EVENT_DELAY, out, scratch_path(spark, "events-checkpoint")).awaitTermination()
    found = submissions.answer(spark.read.parquet(out), key)
    return found.withColumn("submitted_at", F.unix_micros("submitted_at"))


def queries() -> dict[str, Query]:
    return {
        # sources
        "ingest_raw": q_ingest_raw,
        "source_counts": q_source_counts,
        "corrupt_records": q_corrupt_records,
        # data quality
        "dq_report": _layer("dq_report"),
        "dq_numeric": _rule("DQ001"),
        "dq_known_site": _rule("DQ002"),
        "dq_known_metric": _rule("DQ003"),
        "dq_convertible_uom": _rule("DQ004"),
        "dq_validity_period": _rule("DQ005"),
        "dq_non_negative": _rule("DQ006"),
        "dq_multiple_submissions": q_dq_multiple_submissions,
        "dq_domain": _rule("DQ008"),
        "dq_timestamp": _rule("DQ009"),
        "dq_period": _one_rule(quality.PERIOD_RULE),
        "dq_validity_any_version": _one_rule(quality.ANY_VERSION_RULE),
        "dq_quarantine": _layer("dq_quarantine"),
        "dq_gate": q_dq_gate,
        "quarantine_exclusion": _layer("kept_readings"),
        # staging
        "conform_sites": _layer("stg_sites"),
        "conform_metrics": _layer("stg_metrics"),
        "conform_uom": _layer("stg_uom"),
        "typed_readings": _layer("typed_readings"),
        "canonical_units": _layer("in_canonical_units"),
        "latest_submission": _layer("stg_readings"),
        "dedupe_priority": _layer("stg_incidents"),
        # dimensions
        "dim_site": _layer("dim_site"),
        "dim_metric": _layer("dim_metric"),
        "dim_date": q_dim_date,
        # facts
        "quarterly_allocation": q_quarterly_allocation,
        "monthly_values": _layer("monthly_values"),
        "fact_monthly": _layer("fact_monthly"),
        "fact_incident": _layer("fact_incident"),
        # KPIs
        "active_spine": _layer("active_spine"),
        "metric_pivot": q_metric_pivot,
        "kpi_emissions": _layer("kpi_emissions"),
        "kpi_energy_intensity": _layer("kpi_energy_intensity"),
        "monthly_recordables": _layer("monthly_recordables"),
        "rolling_12m": q_rolling_12m,
        "kpi_trir": _layer("kpi_trir"),
        "strict_rollup": q_strict_rollup,
        "two_level_rollup": _layer("yoy_rollup"),
        "kpi_yoy": _layer("kpi_yoy"),
        # contract checks
        "check_unique": q_check_unique,
        "check_orphans": q_check_orphans,
        "check_ranges": q_check_ranges,
        "check_dq_report": q_check_dq_report,
        # publication, increments and their audit
        "publication": q_publication,
        "incremental_build": q_incremental_build,
        "restatement_ledger": q_restatement_ledger,
        "row_ledger": _layer("row_ledger"),
        "row_accounting": _layer("row_accounting"),
        # rules of other sources, versions, comparable perimeters
        "dq_report_sources": q_dq_report_sources,
        "dq_quarantine_sources": q_dq_quarantine_sources,
        "check_versions": _layer("version_conflicts"),
        "version_conflicts": q_version_conflicts,
        "covered_spans": q_covered_spans,
        "as_of": q_as_of,
        "kpi_like_for_like": _layer("kpi_like_for_like"),
        "event_time_latest": q_event_time_latest,
    }
