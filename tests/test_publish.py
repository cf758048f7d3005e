"""Publication: all of a build or nothing of it, versions, and conflicts."""

import os
from dataclasses import replace

import pytest
from helpers import fixture_raw, reading

from greenledger.operators import checks, quality
from greenledger.operators.dims import ReportingWindow
from greenledger.plans.pipeline import PublicationBlocked, ReportingParams, run_pipeline
from greenledger.plans.publish import NotPublished, Publication, PublicationConflict, publish_build

PARAMS = ReportingParams(window=ReportingWindow("2024-01", 24))


def rows(value="3"):
    return [reading(i, site=s, period=f"2024-{m:02d}", code=c, value=value, uom="hours" if c == "HOURS_WORKED" else "t")
            for i, (s, m, c) in enumerate((s, m, c) for s in ("201", "207") for m in (1, 2)
                                          for c in ("SCOPE1_GHG", "SCOPE2_GHG", "HOURS_WORKED"))]


def emissions(df):
    return {(r.period, r.site_id): r.total_tco2e for r in df.collect() if r.total_tco2e is not None}


def test_versions_are_whole_and_stay_readable(spark, fixture_refs, tmp_path):
    root = str(tmp_path / "out")
    reader = Publication(spark, root)
    with pytest.raises(NotPublished):
        reader.manifest()
    first = publish_build(spark, fixture_raw(fixture_refs, spark, rows("3")), root, PARAMS)
    second = publish_build(spark, fixture_raw(fixture_refs, spark, rows("5")), root, PARAMS)
    assert (first.version, second.version) == (1, 2) and reader.versions() == [1, 2]
    assert set(emissions(reader.table("kpi_emissions")).values()) == {10.0}
    assert set(emissions(reader.table("kpi_emissions", version=1)).values()) == {6.0}
    manifest = reader.manifest()
    for name in [*checks.REQUIRED_MARTS, *checks.KPI_CONTRACT, "dq_report", "dq_quarantine"]:
        assert reader.read(manifest, name).count() == manifest.rows[name], name
    assert "_part" not in reader.table("fact_eqs_monthly").columns
    assert set(manifest.tables["fact_eqs_monthly"]) == {"202401", "202402"}
    january = reader.table("fact_eqs_monthly", parts=["202401"])
    assert {r.date_key for r in january.select("date_key").collect()} == {202401}
    assert reader.table("fact_eqs_monthly", parts=["190001"]).count() == 0
    for missing in (lambda: reader.manifest(9), lambda: reader.table("nothing")):
        with pytest.raises(NotPublished):
            missing()


def test_an_empty_month_table_is_published(spark, fixture_refs, tmp_path):
    publish_build(spark, fixture_raw(fixture_refs, spark, []), str(tmp_path), PARAMS)
    fact = Publication(spark, str(tmp_path)).table("fact_eqs_monthly")
    assert fact.count() == 0 and fact.columns[:3] == ["site_key", "date_key", "metric_key"]


def test_a_closed_gate_publishes_nothing(spark, fixture_refs, tmp_path):
    raw = fixture_raw(fixture_refs, spark, [reading(1), reading(2, value="many")])
    rules = tuple(replace(r, action="BLOCK") if r.rule_id == "DQ001" else r for r in quality.DEFAULT_RULES)
    with pytest.raises(PublicationBlocked) as error:
        publish_build(spark, raw, str(tmp_path), replace(PARAMS, rules=rules), gate=True)
    assert Publication(spark, str(tmp_path)).versions() == []
    note = error.value.__notes__[0]
    report = spark.read.option("header", True).csv(note.rpartition(" in ")[2])
    assert {r.action_taken for r in report.where("rule_id = 'DQ001'").collect()} == {"BLOCK"}
    [build] = os.listdir(tmp_path / "builds")
    assert os.listdir(tmp_path / "builds" / build / "reports") == ["dq_report"]
    assert os.listdir(tmp_path / "builds" / build / "tables").count("kpi_trir") == 0


def test_a_broken_contract_keeps_the_last_version(spark, fixture_refs, tmp_path):
    """A quarter and a month of the same quarter make one fact key twice."""
    publish_build(spark, fixture_raw(fixture_refs, spark, rows()), str(tmp_path), PARAMS)
    twice = [reading(1, period="2024-02"), reading(2, period="2024-03", ptype="Q")]
    raw = fixture_raw(fixture_refs, spark, twice)
    with pytest.raises(checks.ContractError, match="fact_eqs_monthly"):
        publish_build(spark, raw, str(tmp_path), PARAMS)
    reader = Publication(spark, str(tmp_path))
    assert reader.versions() == [1] and len(emissions(reader.table("kpi_emissions"))) == 4
    failed = [b for b in os.listdir(tmp_path / "builds") if b != reader.manifest().build]
    assert os.listdir(tmp_path / "builds" / failed[0] / "reports") == ["dq_report"]  # the quality report comes first


def test_of_two_publications_one_wins(spark, tmp_path):
    reader = Publication(spark, str(tmp_path))
    df = spark.createDataFrame([(1,)], "a int")
    df.write.parquet(str(tmp_path / "t"))
    tables, schemas = {"t": {"": str(tmp_path / "t")}}, {"t": df.schema}
    assert reader.commit("one", tables, schemas, None).version == 1
    with pytest.raises(PublicationConflict):
        reader.commit("other", tables, schemas, None)
    assert reader.manifest().build == "one" and reader.commit("next", tables, schemas, 1).version == 2
    assert not [n for n in os.listdir(tmp_path / "_published") if "draft" in n and not n.endswith(".crc")]


def test_tables_of_an_earlier_run_are_not_taken_for_this_one(spark, fixture_refs, tmp_path, monkeypatch):
    from greenledger.plans import pipeline

    raw = fixture_raw(fixture_refs, spark, rows())
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "tables" / "kpi_trir"))  # of an earlier run
    real = pipeline.TableStore.__call__
    monkeypatch.setattr(pipeline.TableStore, "__call__", lambda self, name, df: df if name == "kpi_trir" else real(self, name, df))
    with pytest.raises(checks.ContractError, match="kpi_trir"):
        run_pipeline(spark, raw, str(tmp_path), PARAMS)


def test_command_line_publishes(spark, tmp_path, fixture_refs, fixtures_dir):
    import shutil

    from greenledger.__main__ import main
    from helpers import READING_COLS

    src = tmp_path / "landing"
    src.mkdir()
    for name in ("sites", "metric_definitions", "uom_conversions", "incidents"):
        shutil.copy(fixtures_dir / f"{name}.csv", src / f"{name}.csv")
    (src / "readings.csv").write_text("\n".join([",".join(READING_COLS), "1,201,2024-01,SCOPE1_GHG,5,t,M,P,2024-02-01 08:00:00", ""]))
    assert main([str(src), str(tmp_path / "out"), "--publish", "--gate"]) == 0
    assert Publication(spark, str(tmp_path / "out")).versions() == [1]
