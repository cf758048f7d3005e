"""Direct tests of operators otherwise covered only through the pipeline."""

import datetime as dt

from helpers import fixture_raw, reading

from greenledger.operators import dims, facts, kpis
from greenledger.operators.dims import ReportingWindow
from greenledger.plans.pipeline import ReportingBuild, ReportingParams

PARAMS = ReportingParams(window=ReportingWindow("2024-01", 24))


def _stg(spark, fixture_refs, rows):
    return ReportingBuild(spark, fixture_raw(fixture_refs, spark, rows), PARAMS)


def test_single_pass_monthly_values_equal_union_of_monthly_and_allocated(spark, fixture_refs):
    b = _stg(spark, fixture_refs, [
        reading(1, period="2024-03", code="HOURS_WORKED", value="90", uom="hours", ptype="Q"),
        reading(2, period="2024-03", code="SCOPE1_GHG", value="4"),
        reading(3, period="2024-05", code="SCOPE2_GHG", value="6", ptype="Q")])
    stg = b.stg_readings
    rows = {(r.reading_id, r.value_month, r.month_value, r.is_estimated)
            for r in facts.monthly_values(stg).collect()}
    assert (2, dt.date(2024, 3, 1), 4.0, False) in rows and len(rows) == 7
    assert rows - {(2, dt.date(2024, 3, 1), 4.0, False)} == {
        (r.reading_id, r.value_month, r.month_value, r.is_estimated)
        for r in facts.quarterly_allocation(stg).collect()}
    months = sorted(r.value_month for r in facts.quarterly_allocation(stg)
                    .where("reading_id = 3").collect())
    assert months == [dt.date(2024, 3, 1), dt.date(2024, 4, 1), dt.date(2024, 5, 1)]


def test_metric_pivot_takes_max_and_flags(spark, fixture_refs):
    b = _stg(spark, fixture_refs, [
        reading(1, period="2024-03", code="HOURS_WORKED", value="90", uom="hours", ptype="Q"),
        reading(2, period="2024-02", code="ENERGY_CONS", value="2000", uom="kWh")])
    p = kpis.metric_pivot(b.fact_monthly, b.dim_metric,
                          [("ENERGY_CONS", "energy_mwh"), ("HOURS_WORKED", "hours_worked")],
                          [("HOURS_WORKED", "is_estimated", "est")])
    rows = {r.date_key: r for r in p.collect()}
    assert rows[202402].energy_mwh == 2.0 and rows[202402].hours_worked == 30.0
    assert rows[202402].est is True and rows[202401].energy_mwh is None


def test_rollups_keep_null_business_unit_apart(spark):
    em = spark.createDataFrame(
        [("2024-01", None, 1.0), ("2024-01", "A", 2.0), ("2024-01", "A", None),
         ("2025-01", None, 3.0), ("2025-01", "A", 4.0)],
        "period string, business_unit string, total_tco2e double")
    r = {(x.period, x.grouping_level, x.grouping_value): x.total_tco2e
         for x in kpis.two_level_rollup(em).collect()}
    assert r[("2024-01", "GROUP", "GROUP")] is None           # one site-month missing
    assert r[("2024-01", "BUSINESS_UNIT", "A")] is None
    assert r[("2024-01", "BUSINESS_UNIT", None)] == 1.0
    assert r[("2025-01", "GROUP", "GROUP")] == 7.0
    y = {(x.period, x.grouping_level, x.grouping_value): x
         for x in kpis.kpi_yoy(kpis.two_level_rollup(em)).collect()}
    assert y[("2025-01", "BUSINESS_UNIT", None)].total_tco2e_ly is None   # NULL never matches
    assert y[("2025-01", "BUSINESS_UNIT", "A")].total_tco2e_ly is None    # last year NULL
    assert y[("2025-01", "GROUP", "GROUP")].yoy_pct is None


def test_dim_date_ending_last_full_year(spark):
    df = spark.createDataFrame([(dt.date(2001, 8, 2),), (dt.date(1999, 5, 1),)], "d date")
    got = dims.dim_date(dims.bounds_to_last_full_year(df, "d", 24)).orderBy("date_key").collect()
    assert len(got) == 24 and got[0].date_key == 199901 and got[-1].date_key == 200012
    assert got[-1].month_name == "December" and got[-1].quarter == 4
    full = spark.createDataFrame([(dt.date(2000, 12, 31),)], "d date")
    last = dims.dim_date(dims.bounds_to_last_full_year(full, "d", 12)).agg({"date_key": "max"}).first()
    assert last[0] == 200012


def test_energy_intensity_guards_zero_and_missing(spark, fixture_refs):
    b = _stg(spark, fixture_refs, [
        reading(1, period="2024-01", code="ENERGY_CONS", value="3", uom="MWh"),
        reading(2, period="2024-01", code="HOURS_WORKED", value="0", uom="hours"),
        reading(3, period="2024-02", code="ENERGY_CONS", value="3", uom="MWh"),
        reading(4, period="2024-03", code="ENERGY_CONS", value="3", uom="MWh"),
        reading(5, period="2024-03", code="HOURS_WORKED", value="1500", uom="hours")])
    e = {r.period: r for r in b.kpi_energy_intensity.where("site_id = 201").collect()}
    assert e["2024-01"].hours_worked == 0.0 and e["2024-01"].mwh_per_1000_hours is None
    assert e["2024-02"].hours_worked is None and e["2024-02"].mwh_per_1000_hours is None
    assert e["2024-03"].mwh_per_1000_hours == 2.0 and e["2024-03"].is_estimated is False


def test_a_session_without_a_shared_folder_is_refused_off_the_local_master():
    import pytest

    from greenledger.session import shared_folder

    class Unset:
        def get(self, *_):
            return None

    def session(master):
        class Context:
            def getConf(self):
                return Unset()

            def getCheckpointDir(self):
                return None

        Context.master = master
        return type("Session", (), {"conf": Unset(), "sparkContext": Context()})()

    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session(master))
