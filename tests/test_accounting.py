"""Every raw row comes to one end."""

from collections import Counter

from helpers import fixture_raw, reading

from greenledger.operators.dims import ReportingWindow
from greenledger.plans.pipeline import ReportingBuild, ReportingParams
from greenledger.sources.raw import RAW_COLUMNS, string_schema

PARAMS = ReportingParams(window=ReportingWindow("2024-01", 24))


def ledger(spark, raw):
    return ReportingBuild(spark, raw, PARAMS).row_ledger


def test_ends_of_readings(spark, fixture_refs):
    rows = {
        "FACT": [reading(1), reading(2, code="SCOPE2_GHG", period="2024-03", ptype="Q")],
        "SUPERSEDED": [reading(3, submitted="2024-02-01 08:00:00")],
        "QUARANTINED": [reading(4, value="x"), reading(5, site="999"), reading(None, ptype="W")],
        "QUARANTINED_COPY": [reading(4, period="2024-07"), reading(5, period="2024-08")],
        "NO_DATE": [reading(6, period="soon")],
        "OUT_OF_WINDOW": [reading(7, period="2026-02")],
    }
    raw = fixture_raw(fixture_refs, spark, [r for rs in rows.values() for r in rs])
    got = [r for r in ledger(spark, raw).where("source = 'readings'").collect()]
    assert Counter(r.end for r in got) == {end: len(rs) for end, rs in rows.items()}
    ends = {(r.row_id, r.end): r.rule_id for r in got}
    assert ends["4", "QUARANTINED"] == "DQ001" and ends["5", "QUARANTINED"] == "DQ002" and ends[None, "QUARANTINED"] == "DQ008"
    assert ends["3", "SUPERSEDED"] is None and ("1", "FACT") in ends


def test_copies_of_one_row_have_one_winner(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [reading(1)] * 5)
    got = Counter(r.end for r in ledger(spark, raw).where("source = 'readings'").collect())
    assert got == {"FACT": 1, "SUPERSEDED": 4}


def test_ends_of_incidents(spark, fixture_refs):
    def incident(i, site="1", day="2024-05-05", lost="1"):
        return (str(i), site, day, "Fall", "Low", "Y", lost, "Lead")

    sites = [("1", "A", "DE", "x", "BU", "3", "2020-01-01", ""), ("2", "B", "DE", "x", "BU", "3", "2024-03-01", "2024-06-30"),
             ("2", "B", "DE", "x", "BU", "3", "2024-09-01", "2025-02-28")]
    rows = [incident(1), incident(2), incident(2, lost="0"), incident(3, day="never"), incident(4, site="9"), incident(5, day="2023-12-31"),
            incident(6, "2", "2024-02-01"), incident(7, "2", "2025-03-01"), incident(8, "2", "2024-07-01"), incident(9, "2", "2024-06-30")]
    raw = fixture_raw(fixture_refs, spark, []) | {
        "sites": spark.createDataFrame(sites, string_schema(RAW_COLUMNS["sites"])),
        "incidents": spark.createDataFrame(rows, string_schema(RAW_COLUMNS["incidents"]))}
    got = Counter((r.row_id, r.end) for r in ledger(spark, raw).where("source = 'incidents'").collect())
    assert got == Counter([("1", "FACT"), ("2", "FACT"), ("2", "SUPERSEDED"), ("3", "NO_DATE"), ("4", "UNKNOWN_SITE"),
                           ("5", "OUT_OF_WINDOW"), ("6", "BEFORE_ACQUISITION"), ("7", "AFTER_DIVESTMENT"),
                           ("8", "BETWEEN_VERSIONS"), ("9", "FACT")])


def test_ends_add_up(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [reading(i % 7 or None, site=str(199 + i % 9), period=f"2024-{i % 13 + 1:02d}",
                                                    value=str(i % 5 - 1)) for i in range(90)])
    b = ReportingBuild(spark, raw, PARAMS)
    got = {}
    for r in b.row_accounting.collect():
        got[r.source] = got.get(r.source, 0) + r.row_count
    assert got == {"readings": 90, "incidents": raw["incidents"].count()}
    facts = b.row_ledger.where("end = 'FACT' AND source = 'incidents'").count()
    assert facts == b.fact_incident.count()
