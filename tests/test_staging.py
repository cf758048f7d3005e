"""Staging: conforming, typing, units, latest-submission and incident dedup."""

import datetime as dt

from helpers import fixture_raw, reading

from greenledger.operators import conform


def test_conform_sites_aliases_trim_and_open_end(fixture_refs):
    rows = {r.site_id: r for r in conform.conform_sites(fixture_refs["sites"]).collect()}
    assert len(rows) == 14
    assert rows[202].country == "US" and rows[203].country == "US"
    assert rows[204].country == "DE" and rows[214].country == "DE"
    assert rows[203].site_name == "Birch Lane Depot"
    assert rows[201].valid_to is None
    assert rows[207].valid_to == dt.date(2025, 2, 28)
    assert rows[211].valid_from == dt.date(2024, 8, 1)


def test_conform_metrics_flag_defaults_false(spark):
    df = spark.createDataFrame([("A", "n", "c", "t", "Y"), ("B", "n", "c", "t", " y "),
                                ("C", "n", "c", "t", None), ("D", "n", "c", "t", "N")],
                               "metric_code string, metric_name string, category string, "
                               "canonical_uom string, is_additive string")
    got = {r.metric_code: r.is_additive for r in conform.conform_metrics(df).collect()}
    assert got == {"A": True, "B": True, "C": False, "D": False}


def test_typed_readings_periods_and_values(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [
        reading(1, period="2024-01", value="1_000"), reading(2, period="2024-1", value=" 5 "),
        reading(3, period="2024", value="1d"), reading(4, period="2024-Q1", value="1,000"),
        reading(5, period=None, value="nan"), reading(6, value=""),
    ])
    got = {r.reading_id: r for r in conform.typed_readings(raw["readings"]).collect()}
    assert got[1].period_start == dt.date(2024, 1, 1) and got[1].raw_value == 1000.0
    assert got[2].period_start == dt.date(2024, 1, 1) and got[2].raw_value == 5.0
    assert got[3].period_start is None and got[3].raw_value is None
    assert got[4].period_start is None and got[4].raw_value is None
    assert got[5].period_start is None and got[5].raw_value != got[5].raw_value  # NaN
    assert got[6].raw_value is None


def _staged(spark, fixture_refs, rows):
    raw = fixture_raw(fixture_refs, spark, rows)
    typed = conform.typed_readings(raw["readings"])
    converted = conform.canonical_units(typed, conform.conform_metrics(raw["metric_definitions"]),
                                        conform.conform_uom(raw["uom_conversions"]))
    return converted, conform.latest_submission(converted)


def test_units_normalised_and_trimmed_keys_accepted(spark, fixture_refs):
    converted, _ = _staged(spark, fixture_refs, [
        reading(1, code="ENERGY_CONS", value="500", uom="kWh"),
        reading(2, code="SCOPE1_GHG", value="2000", uom=" kg "),
        reading(3, code="ENERGY_CONS", value="1", uom="gal"),    # no conversion: dropped
    ])
    got = {r.reading_id: r.canonical_value for r in converted.collect()}
    assert got == {1: 0.5, 2: 2.0}


def test_latest_submission_wins_with_reading_id_tie_break(spark, fixture_refs):
    _, latest = _staged(spark, fixture_refs, [
        reading(1, value="1", submitted="2024-02-01 08:00:00"),
        reading(2, value="2", submitted="2024-02-03 08:00:00"),
        reading(3, value="3", submitted="2024-02-03 08:00:00"),   # same time, higher id
        reading(4, code="SCOPE2_GHG", value="4"),
    ])
    rows = {r.metric_code: r for r in latest.collect()}
    assert rows["SCOPE1_GHG"].reading_id == 3
    assert rows["SCOPE1_GHG"].submission_count == 3 and rows["SCOPE1_GHG"].is_restatement
    assert rows["SCOPE2_GHG"].submission_count == 1 and not rows["SCOPE2_GHG"].is_restatement


def test_incident_dedup_prefers_most_lost_days_then_reporter(spark, fixture_refs):
    typed = conform.typed_incidents(fixture_refs["incidents"])
    assert typed.count() == 19
    staged = {r.incident_id: r for r in conform.dedupe_priority(typed).collect()}
    assert len(staged) == 18
    assert staged[8111].lost_days == 17 and staged[8111].reported_by == "EHS Officer"
    tie = spark.createDataFrame(
        [("1", "201", "2024-01-01", "T", "Low", "Y", "3", "Line Manager"),
         ("1", "201", "2024-01-01", "T", "Low", "Y", "3", "EHS Officer")],
        ", ".join(f"{c} string" for c in fixture_refs["incidents"].columns))
    best = conform.dedupe_priority(conform.typed_incidents(tie)).collect()
    assert len(best) == 1 and best[0].reported_by == "EHS Officer"
