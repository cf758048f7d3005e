"""Scale behaviour on small data: the distributed dense-key path, hot keys
(one key holding a third of all rows) and map-side combining."""

import contextlib
import io

import duckdb
from helpers import fixture_raw, reading

from greenledger.operators import conform, quality as q
from greenledger.operators.keys import dense_key


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_dense_key_numbers_like_a_window(spark):
    df = spark.range(0, 5000).selectExpr(
        "CAST(id % 997 AS INT) AS a", "CAST((id * 7919) % 1013 AS INT) AS b",
        "IF(id % 50 = 0, NULL, CAST(id AS STRING)) AS c")
    got = {(r.a, r.b, r.c): r.k for r in dense_key(df, ["a", "b"], "k", partitions=7).collect()}
    assert sorted(got.values()) == list(range(1, 5001))
    assert {(r.a, r.b, r.c): r.k for r in dense_key(df, ["a", "b"], "k").collect()} == got
    assert dense_key(df.limit(0), ["a", "b"], "k").collect() == []
    con = duckdb.connect()
    con.register("t", df.toPandas())
    want = dict(((a, b, c), k) for a, b, c, k in con.execute(
        "SELECT a, b, c, row_number() OVER (ORDER BY a NULLS LAST, b NULLS LAST, "
        "c NULLS LAST) FROM t").fetchall())
    assert {(a, b, None if c != c else c): k for (a, b, c), k in want.items()} == got


def _hot_rows(n=3000):
    rows = []
    for i in range(n):
        if i % 3 == 0:   # a third of all rows on one key
            rows.append(reading(10_000 + i, site="201", period="2024-01",
                                value=str(i % 17), submitted=f"2024-02-{i % 28 + 1:02d} 08:00:00"))
        else:
            rows.append(reading(10_000 + i, site=str(201 + i % 12), period=f"2024-{i % 12 + 1:02d}",
                                code=("SCOPE1_GHG", "SCOPE2_GHG", "ENERGY_CONS")[i % 3],
                                uom=("t", "t", "MWh")[i % 3], value=str(i % 23)))
    return rows


def test_hot_key_report_and_latest_submission_are_exact(spark, fixture_refs):
    rows = _hot_rows()
    raw = fixture_raw(fixture_refs, spark, rows)
    flagged = q.flag_readings(raw["readings"], raw)
    rep = {r.rule_id: r for r in q.dq_report(flagged).collect()}
    con = duckdb.connect()
    con.register("r", raw["readings"].toPandas())
    dup = con.execute("SELECT coalesce(sum(n), 0) FROM (SELECT count(*) n FROM r "
                      "GROUP BY site_id, period, metric_code HAVING count(*) > 1)").fetchone()[0]
    assert rep["DQ007"].rows_failed == dup
    typed = conform.typed_readings(q.quarantine_exclusion(raw["readings"],
                                                          q.dq_quarantine(flagged)))
    conv = conform.canonical_units(typed, conform.conform_metrics(raw["metric_definitions"]),
                                   conform.conform_uom(raw["uom_conversions"]))
    latest = conform.latest_submission(conv)
    hot = latest.where("site_id = 201 AND period_start = DATE '2024-01-01' "
                       "AND metric_code = 'SCOPE1_GHG'").collect()
    assert len(hot) == 1
    want = con.execute(
        "SELECT reading_id, count(*) OVER () FROM r WHERE site_id = '201' AND period = '2024-01' "
        "AND metric_code = 'SCOPE1_GHG' ORDER BY submitted_at DESC, CAST(reading_id AS BIGINT) "
        "DESC LIMIT 1").fetchone()
    assert (hot[0].reading_id, hot[0].submission_count) == (int(want[0]), want[1])
    plan = _plan(latest)
    assert "partial_max" in plan          # combined map-side before the shuffle
    assert "partial_count" in _plan(q.dq_report(flagged))


def test_results_do_not_depend_on_how_lookups_are_joined(spark, fixture_refs):
    """The same build with Spark's broadcast threshold off: every lookup is a
    sort-merge join, from the rules to the KPIs."""
    from greenledger.operators.dims import ReportingWindow
    from greenledger.plans.pipeline import ReportingBuild, ReportingParams

    rows = _hot_rows(600) + [reading(5, value="x"), reading(5), reading(6, site="999")]

    def run():
        b = ReportingBuild(spark, fixture_raw(fixture_refs, spark, rows),
                           ReportingParams(window=ReportingWindow("2024-01", 24)))
        frames = [b.dq_report, b.kept_readings, b.fact_monthly, b.fact_incident, b.kpi_emissions, b.kpi_trir]
        return [sorted(map(repr, f.collect())) for f in frames], _plan(b.fact_monthly)

    first, plan = run()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        second, merged = run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        if adaptive is not None:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", adaptive)
    assert first == second
    assert "SortMergeJoin" in merged and "BroadcastHashJoin" not in merged
