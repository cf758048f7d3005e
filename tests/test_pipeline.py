"""End-to-end build, sinks and contracts on the fixtures."""

import glob
import os
import tempfile

import pytest
from helpers import FIXTURES, fixture_raw, reading

from greenledger.operators import checks
from greenledger.operators.dims import ReportingWindow
from greenledger.plans.pipeline import ReportingParams, run_pipeline
from greenledger.sources.raw import RAW_COLUMNS, ingest_raw, ingest_sources, source_counts


def test_ingest_checks_header_and_keeps_spaces(spark):
    df = ingest_raw(spark, str(FIXTURES / "sites.csv"), RAW_COLUMNS["sites"])
    rows = {r.site_id: r for r in df.collect()}
    assert len(rows) == 14
    assert rows["214"].country == "germany " and rows["203"].site_name == "Birch Lane Depot "
    assert rows["201"].valid_to is None          # blank cell, CRLF line ending stripped
    wrong = ingest_raw(spark, str(FIXTURES / "sites.csv"), RAW_COLUMNS["incidents"])
    with pytest.raises(Exception):
        wrong.collect()


def test_missing_source_file_is_an_error(spark):
    with pytest.raises(FileNotFoundError) as err:
        ingest_sources(spark, str(FIXTURES))      # no readings.csv among the fixtures
    assert "readings.csv" in str(err.value)


def test_source_counts(spark, fixture_refs):
    got = {r.table_name: r.row_count for r in source_counts(fixture_refs).collect()}
    assert got == {"sites": 14, "metric_definitions": 6, "uom_conversions": 8, "incidents": 19}


def test_run_pipeline_writes_contract_reports(spark, fixture_refs):
    rows = [reading(i, site=s, period=f"2024-{m:02d}", code=c, value="3",
                    uom="hours" if c == "HOURS_WORKED" else "t")
            for i, (s, m, c) in enumerate((s, m, c) for s in ("201", "207") for m in (1, 2)
                                          for c in ("SCOPE1_GHG", "SCOPE2_GHG", "HOURS_WORKED"))]
    raw = fixture_raw(fixture_refs, spark, rows)
    out = tempfile.mkdtemp(prefix="greenledger-test-", dir="/tmp")
    params = ReportingParams(window=ReportingWindow("2024-01", 24))
    b = run_pipeline(spark, raw, out, params)
    for name, cols in checks.KPI_CONTRACT.items():
        parts = glob.glob(os.path.join(out, "reports", name, "part-*.csv"))
        assert parts, name
        header = open(sorted(parts)[0]).readline().strip().split(",")
        assert header == cols
        assert spark.read.option("header", True).csv(os.path.join(out, "reports", name)).count() > 0
    assert os.path.isdir(os.path.join(out, "tables", "fact_eqs_monthly"))
    # Clean readings: the quarantine table is still written (typed, empty).
    quarantine = spark.read.parquet(os.path.join(out, "tables", "dq_quarantine"))
    assert quarantine.count() == 0 and quarantine.columns[0] == "rule_id"
    assert os.path.isdir(os.path.join(out, "tables", "dq_flags"))
    table = lambda n: spark.read.parquet(os.path.join(out, "tables", n))
    for name in [*checks.REQUIRED_MARTS, *checks.KPI_CONTRACT]:
        table(name)
    assert all(r.duplicate_keys == 0 for r in table("check_unique").collect())
    assert {r.check_name for r in table("check_unique").collect()} == set(checks.REQUIRED_MARTS)
    assert all(r.orphan_rows == 0 for r in table("check_orphans").collect())
    rng = table("check_ranges").first()
    assert rng.covers_window and rng.yoy_both_levels and rng.kpis_not_empty
    assert rng.dim_site_rows == 14 and rng.dim_date_rows == 24 and rng.dim_metric_rows == 6
    dq = table("check_dq_report").first()
    assert dq.rules == 9 and dq.all_rules_checked_rows


def test_a_missing_required_table_is_an_error(spark, fixture_refs, monkeypatch):
    from greenledger.plans import pipeline

    raw = fixture_raw(fixture_refs, spark, [reading(1)])
    out = tempfile.mkdtemp(prefix="greenledger-test-", dir="/tmp")
    real = pipeline.TableStore.__call__

    def lose(self, name, df):
        return df if name == "fact_eqs_monthly" else real(self, name, df)

    monkeypatch.setattr(pipeline.TableStore, "__call__", lose)
    with pytest.raises(checks.ContractError, match="fact_eqs_monthly"):
        run_pipeline(spark, raw, out, ReportingParams(window=ReportingWindow("2024-01", 24)))


def test_the_gate_stops_the_kpi_reports_only(spark, fixture_refs):
    from dataclasses import replace

    from greenledger.operators import quality
    from greenledger.plans.pipeline import PublicationBlocked

    raw = fixture_raw(fixture_refs, spark, [reading(1), reading(2, value="many")])
    rules = tuple(replace(r, action="BLOCK") if r.rule_id == "DQ001" else r for r in quality.DEFAULT_RULES)
    params = ReportingParams(window=ReportingWindow("2024-01", 24), rules=rules)
    out = tempfile.mkdtemp(prefix="greenledger-test-", dir="/tmp")
    with pytest.raises(PublicationBlocked):
        run_pipeline(spark, raw, out, params, gate=True)
    assert sorted(os.listdir(os.path.join(out, "reports"))) == ["dq_report"]
    run_pipeline(spark, raw, out, params)
    assert len(os.listdir(os.path.join(out, "reports"))) == 5


def test_contract_violation_is_reported(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(checks.ContractError):
        checks.check_columns(df, ["b", "a"], "x")
    with pytest.raises(checks.ContractError):
        checks.check_required({"dim_site": df}, checks.REQUIRED_MARTS)


def test_command_line_build(spark, tmp_path):
    import shutil

    from helpers import READING_COLS

    from greenledger.__main__ import main

    src = tmp_path / "landing"
    src.mkdir()
    for name in ("sites", "metric_definitions", "uom_conversions", "incidents"):
        shutil.copy(FIXTURES / f"{name}.csv", src / f"{name}.csv")
    with pytest.raises(FileNotFoundError):
        main([str(src), str(tmp_path / "out0")])
    lines = [",".join(READING_COLS)]
    for i in range(24):
        period = f"{2024 + i // 12}-{i % 12 + 1:02d}"
        for code, uom in (("SCOPE1_GHG", "t"), ("SCOPE2_GHG", "kg"), ("HOURS_WORKED", "hours")):
            lines.append(f"{len(lines)},201,{period},{code},12,{uom},M,PORTAL,"
                         f"{period}-05 08:00:00")
    (src / "readings.csv").write_text("\r\n".join(lines) + "\r\n")
    assert main([str(src), str(tmp_path / "out")]) == 0
    for name in ("dq_report", "kpi_emissions", "kpi_energy_intensity", "kpi_trir", "kpi_yoy"):
        assert glob.glob(str(tmp_path / "out" / "reports" / name / "part-*.csv")), name
    em = spark.read.option("header", True).csv(str(tmp_path / "out" / "reports" / "kpi_emissions"))
    row = em.where("site_id = '201' AND period = '2024-06'").first()
    assert float(row.total_tco2e) == 12.012
