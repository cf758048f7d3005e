"""Malformed lines, rules of other sources, version sweeps, as-of lookup, like for like."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from helpers import READING_COLS, fixture_raw, reading

from greenledger.operators import kpis, quality, rulebooks, versions
from greenledger.plans.pipeline import ReportingBuild
from greenledger.sources.raw import CORRUPT, RAW_COLUMNS, ingest_with_corrupt, string_schema

GOOD = "1,201,2024-01,SCOPE1_GHG,5,t,M,PORTAL,2024-02-01 08:00:00"


def test_malformed_lines_are_found_again(spark, fixture_refs, tmp_path):
    lines = [",".join(READING_COLS), GOOD, "", '2,201,2024-01,SCOPE1_GHG,"5,5",t,M,"P ""x""",2024-02-01 08:00:00',
             "3,201,2024-01", GOOD + ",more,and more", '4,"201,2024-01,SCOPE1_GHG,5,t,M,PORTAL,2024-02-01 08:00:00',
             '5,201,2024-01,SCOPE1_GHG,5,t,M,PORTAL,"2024', " 6 ,201,2024-01,SCOPE1_GHG,,t,M,PORTAL,2024-02-01 08:00:00"]
    (tmp_path / "r.csv").write_text("\r\n".join(lines) + "\r\n")
    rows, bad = ingest_with_corrupt(spark, str(tmp_path / "r.csv"), READING_COLS, "readings")
    assert {(r.fault, r.fields, r.line) for r in bad.collect()} == {
        ("SHORT", 3, lines[4]), ("LONG", 11, lines[5]), ("UNCLOSED", None, lines[6]), ("UNCLOSED", None, lines[7])}
    got = {r.reading_id: r for r in rows.collect()}
    assert set(got) == {"1", "2", " 6 "} and got["2"].value == "5,5" and got[" 6 "].value is None
    raw = fixture_raw(fixture_refs, spark, []) | {"readings": rows, CORRUPT: bad}
    build = ReportingBuild(spark, raw)
    report = {r.rule_id: r for r in build.dq_report.collect()}
    assert (report["DQ000"].rows_checked, report["DQ000"].rows_failed, report["DQ000"].action_taken) == (7, 4, "QUARANTINE")
    held = build.dq_quarantine.where("rule_id = 'DQ000'").collect()
    assert {r.value for r in held} == set(lines[4:8]) and all(r.reason.startswith("line is malformed: ") for r in held)
    (tmp_path / "no.csv").write_text(GOOD + "\n")
    with pytest.raises(ValueError, match="no.csv"):
        ingest_with_corrupt(spark, str(tmp_path / "no.csv"), READING_COLS, "readings")


def test_rules_of_incidents_and_sites(spark, fixture_refs):
    def incident(i, site="1", day="2024-05-05", recordable="Y", lost="1"):
        return (str(i), site, day, "Fall", "Low", recordable, lost, "Lead")

    sites = [("1", "A", "DE", "x", "BU", "3", "2024-01-01", "2024-06-30"), ("1", "A", "DE", "x", "BU", "0", "2024-09-01", " "),
             ("2", "B", "DE", "x", "BU", "many", "soon", "later")]
    rows = [incident(1), incident(1), incident(2, site="9"), incident(3, day="x"), incident(4, day="2024-07-01"), incident(5, day="2024-06-30"),
            incident(6, day="2030-01-01"), incident(7, lost="-1"), incident(8, lost="1.5"), incident(9, recordable=None)]
    tables = fixture_raw(fixture_refs, spark, []) | {
        "sites": spark.createDataFrame(sites, string_schema(RAW_COLUMNS["sites"])),
        "incidents": spark.createDataFrame(rows, string_schema(RAW_COLUMNS["incidents"]))}
    report = {r.rule_id: (r.source, r.rows_checked, r.rows_failed, r.action_taken) for r in rulebooks.report_of_sources(tables).collect()}
    assert report == {
        "DQ101": ("incidents", 10, 1, "QUARANTINE"), "DQ102": ("incidents", 10, 1, "QUARANTINE"), "DQ103": ("incidents", 9, 1, "QUARANTINE"),
        "DQ104": ("incidents", 10, 1, "QUARANTINE"), "DQ105": ("incidents", 10, 1, "FLAG"), "DQ106": ("incidents", 10, 2, "FLAG"),
        "DQ201": ("sites", 3, 1, "QUARANTINE"), "DQ202": ("sites", 3, 1, "QUARANTINE"), "DQ203": ("sites", 3, 2, "FLAG"),
        "DQ204": ("sites", 3, 2, "FLAG")}
    found = Counter((r.rule_id, r.row_id, r.value) for r in rulebooks.quarantine_of_sources(tables).collect())
    assert found[("DQ103", "4", "2024-07-01")] == 1 and found[("DQ104", "7", "-1")] == 1 and found[("DQ203", "2", "many")] == 1
    assert sum(found.values()) == sum(r[2] for i, r in report.items() if i not in ("DQ106", "DQ204"))
    assert set(quality.REPORT_COLUMNS) < set(rulebooks.report_of_sources(tables).columns)


def spans(spark, rows):
    return spark.createDataFrame(rows, "k string, valid_from date, valid_to date")


def test_conflicts_of_versions(spark):
    d = date.fromisoformat
    rows = [("a", d("2024-01-01"), d("2024-12-31")), ("a", d("2024-02-01"), d("2024-02-10")), ("a", d("2024-06-01"), d("2024-06-30")),
            ("a", d("2025-03-01"), None), ("b", d("2024-01-01"), d("2024-01-31")), ("b", d("2024-02-01"), None),
            ("c", d("2024-05-10"), d("2024-05-01")), ("d", d("2024-01-01"), d("2024-09-17")), ("d", d("2024-09-18"), None),
            (None, d("2024-01-01"), None), ("e", None, None)]
    got = {tuple(r) for r in versions.version_conflicts(spans(spark, rows), "k").collect()}
    assert got == {("a", "OVERLAP", d("2024-02-01"), d("2024-02-10"), 10), ("a", "OVERLAP", d("2024-06-01"), d("2024-06-30"), 30),
                   ("a", "HOLE", d("2025-01-01"), d("2025-02-28"), 59), ("c", "REVERSED", d("2024-05-10"), d("2024-05-01"), -8)}
    by_month = {tuple(r)[:4] for r in versions.version_conflicts(spans(spark, rows), "k", month=True).collect()}
    assert ("d", "OVERLAP", d("2024-09-01"), d("2024-09-30")) in by_month and not any(r[0] == "b" for r in by_month)
    covered = {tuple(r) for r in versions.covered_spans(spans(spark, rows), "k").collect()}
    assert covered == {("a", d("2024-01-01"), d("2024-12-31"), 3), ("a", d("2025-03-01"), None, 1), ("b", d("2024-01-01"), None, 2),
                       ("d", d("2024-01-01"), None, 2)}


def test_as_of_carries_across_ranges(spark):
    rng, start = random.Random(2), datetime(2024, 1, 1)

    def moment():
        return start + timedelta(minutes=rng.randint(0, 3000))

    known = [(rng.choice(("hot", "hot", "x", None)), moment(), i) for i in range(40)] + [("hot", start + timedelta(minutes=5), 99)] * 2
    asked = [(i, rng.choice(("hot", "hot", "hot", "x", "y", None)), moment() if i % 50 else None) for i in range(600)]
    got = versions.as_of(spark.createDataFrame(asked, "id int, key string, at timestamp"),
                         spark.createDataFrame(known, "key string, since timestamp, v int"), "key", "at", "since", "v")
    assert got.columns == ["id", "key", "at", "since_as_of", "v_as_of"]
    rows = got.collect()
    assert len(rows) == 600
    for r in rows:
        best = max(((s, v) for k, s, v in known if k is not None and k == r.key and r["at"] is not None and s <= r["at"]), default=(None, None))
        assert (r.since_as_of, r.v_as_of) == best


def test_like_for_like_cuts_the_perimeter_first(spark):
    rows = [("2024-01", 1, "B1", 10.0), ("2024-01", 2, "B1", 5.0), ("2024-01", 3, "B2", None), ("2025-01", 1, "B1", 12.0),
            ("2025-01", 3, "B2", 7.0), ("2025-01", 4, "B2", 100.0), ("2025-02", 1, "B1", 3.0)]
    df = spark.createDataFrame(rows, "period string, site_id int, business_unit string, total_tco2e double")
    got = {(r.grouping_level, r.grouping_value): tuple(r)[3:] for r in kpis.like_for_like(df).collect()}
    assert got == {("GROUP", "GROUP"): (1, 12.0, 10.0, 2.0, 0.2), ("BUSINESS_UNIT", "B1"): (1, 12.0, 10.0, 2.0, 0.2)}


def test_reading_rules_are_unchanged_beside_the_books(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [reading(1), reading(2, value="x")])
    report = {r.rule_id: r.rows_failed for r in ReportingBuild(spark, raw).dq_report.collect()}
    assert report["DQ001"] == 1 and "DQ000" not in report
