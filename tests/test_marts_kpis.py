"""Dimensions, facts and KPIs on the fixture sites (window 2024-01..2025-12)."""

import datetime as dt

import pytest
from helpers import fixture_raw, reading

from greenledger.operators.dims import ReportingWindow
from greenledger.plans.pipeline import ReportingBuild, ReportingParams

PARAMS = ReportingParams(window=ReportingWindow("2024-01", 24))


def _build(spark, fixture_refs, rows):
    return ReportingBuild(spark, fixture_raw(fixture_refs, spark, rows), PARAMS)


def _month(i):  # i = 0 -> 2024-01
    return f"{2024 + i // 12}-{i % 12 + 1:02d}"


def test_dimensions_and_spine_goldens(spark, fixture_refs):
    b = _build(spark, fixture_refs, [reading(1)])
    assert b.dim_site.count() == 14
    assert b.dim_date.count() == 24
    assert b.dim_metric.count() == 6
    keys = sorted(r.site_key for r in b.dim_site.collect())
    assert keys == list(range(1, 15))
    by_site = {r.site_id: r.site_key for r in b.dim_site.collect()}
    assert [by_site[s] for s in sorted(by_site)] == list(range(1, 15))
    assert [r.metric_code for r in b.dim_metric.orderBy("metric_key").collect()] == sorted(
        ["SCOPE1_GHG", "SCOPE2_GHG", "ENERGY_CONS", "WATER_WD", "WASTE_TOTAL", "HOURS_WORKED"])
    d = b.dim_date.orderBy("date_key").collect()
    assert (d[0].date_key, d[0].period, d[0].quarter, d[0].month_name) == \
        (202401, "2024-01", 1, "January")
    # nine sites for 24 months, the others for 10, 14, 17, 17 and 22
    assert b.active_spine.count() == 296
    assert b.kpi_emissions.count() == 296
    assert b.kpi_yoy.count() == 24 * 6                        # the group and five units


def test_fact_incident_day_level_validity(spark, fixture_refs):
    b = _build(spark, fixture_refs, [reading(1)])
    ids = {r.incident_id: r for r in b.fact_incident.collect()}
    assert len(ids) == 11
    assert sum(r.is_recordable for r in ids.values()) == 8
    assert {8105, 8107, 8110, 8112, 8117} <= set(ids)         # boundary days kept
    assert not {8106, 8108, 8109, 8113, 8114, 8115, 8116} & set(ids)  # outside validity / window
    assert ids[8111].lost_days == 17


def test_month_level_validity_for_readings_vs_day_level_for_incidents(spark, fixture_refs):
    rows = [reading(1, site="207", period="2025-02", code="HOURS_WORKED", value="100",
                    uom="hours"),
            reading(2, site="207", period="2025-03", code="HOURS_WORKED", value="100",
                    uom="hours")]
    b = _build(spark, fixture_refs, rows)
    months = {r.date_key for r in b.fact_monthly.collect()}
    assert months == {202502}


def test_quarterly_allocation_fans_out_to_three_estimated_months(spark, fixture_refs):
    b = _build(spark, fixture_refs, [
        reading(1, period="2024-03", code="HOURS_WORKED", value="300", uom="hours", ptype="Q")])
    rows = sorted((r.date_key, r.value, r.is_estimated) for r in b.fact_monthly.collect())
    assert rows == [(202401, 100.0, True), (202402, 100.0, True), (202403, 100.0, True)]
    ei = {r.period: r for r in b.kpi_energy_intensity.where("site_id = 201").collect()}
    assert ei["2024-02"].is_estimated and not ei["2024-04"].is_estimated


def test_missing_month_is_null_and_zero_is_zero(spark, fixture_refs):
    b = _build(spark, fixture_refs, [
        reading(1, period="2024-01", code="SCOPE1_GHG", value="0"),
        reading(2, period="2024-01", code="SCOPE2_GHG", value="0"),
        reading(3, period="2024-02", code="SCOPE1_GHG", value="5")])
    em = {r.period: r for r in b.kpi_emissions.where("site_id = 201").collect()}
    assert em["2024-01"].total_tco2e == 0.0
    assert em["2024-02"].scope1_tco2e == 5.0 and em["2024-02"].total_tco2e is None
    assert em["2024-03"].scope1_tco2e is None and em["2024-03"].total_tco2e is None


def _hours(site, months, value="1000", skip=()):
    return [reading(f"{site}{i:03d}", site=site, period=_month(i), code="HOURS_WORKED",
                    value=value, uom="hours") for i in range(months) if i not in skip]


def test_trir_gating(spark, fixture_refs):
    rows = (_hours("201", 24) + _hours("202", 24, skip=(5,)) + _hours("204", 24, value="0"))
    b = _build(spark, fixture_refs, rows)
    t = {(r.site_id, r.period): r for r in b.kpi_trir.collect()}
    assert t[(201, "2024-11")].trir_r12 is None and not t[(201, "2024-11")].has_full_window
    full = t[(201, "2024-12")]
    assert full.has_full_window and full.hours_worked_r12 == 12000.0
    assert full.recordable_incidents_r12 == 1                       # 8102 (8103 not recordable)
    assert full.trir_r12 == pytest.approx(1 * 200000.0 / 12000.0)
    gap = t[(202, "2024-12")]
    assert not gap.has_full_window and gap.trir_r12 is None and gap.hours_worked_r12 == 11000.0
    assert t[(202, "2025-06")].has_full_window                      # gap left the window
    assert t[(204, "2024-12")].trir_r12 is None and t[(204, "2024-12")].has_full_window


def test_strict_rollup_and_yoy(spark, fixture_refs):
    rows = []
    for site in ("201", "202", "204", "209"):                     # business unit Paper
        for i in range(24):
            if site == "209" and i == 13:
                continue                                          # one gap in 2025-02
            rows.append(reading(f"{site}1{i:03d}", site=site, period=_month(i),
                                code="SCOPE1_GHG", value="10"))
            rows.append(reading(f"{site}2{i:03d}", site=site, period=_month(i),
                                code="SCOPE2_GHG", value="0" if i < 12 else "5"))
    b = _build(spark, fixture_refs, rows)
    y = {(r.period, r.grouping_level, r.grouping_value): r for r in b.kpi_yoy.collect()}
    ps = y[("2025-01", "BUSINESS_UNIT", "Paper")]
    assert ps.total_tco2e == 60.0 and ps.total_tco2e_ly == 40.0
    assert ps.yoy_abs == 20.0 and ps.yoy_pct == pytest.approx(0.5)
    assert y[("2025-02", "BUSINESS_UNIT", "Paper")].total_tco2e is None
    assert y[("2024-05", "BUSINESS_UNIT", "Paper")].total_tco2e_ly is None
    assert y[("2025-01", "GROUP", "GROUP")].total_tco2e is None      # other BUs missing
    levels = {k[1] for k in y}
    assert levels == {"GROUP", "BUSINESS_UNIT"}


def test_yoy_pct_null_when_last_year_zero(spark, fixture_refs):
    rows = []
    for i in (0, 12):
        for code, v in (("SCOPE1_GHG", "0" if i == 0 else "3"), ("SCOPE2_GHG", "0")):
            rows.append(reading(f"9{i:02d}{code[5]}", period=_month(i), code=code, value=v))
    b = _build(spark, fixture_refs, rows)
    em = b.kpi_emissions.where("site_id = 201 and period in ('2024-01', '2025-01')")
    assert em.count() == 2
    from greenledger.operators import kpis
    r = kpis.strict_rollup(em, ["period"], "total_tco2e").collect()
    assert sorted((x.period, x.total_tco2e) for x in r) == [("2024-01", 0.0), ("2025-01", 3.0)]
