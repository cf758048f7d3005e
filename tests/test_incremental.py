"""An increment gives what a full build gives, and writes only the months it touches."""

import random

import pytest
from helpers import READING_COLS, fixture_raw, reading

from greenledger.operators import checks
from greenledger.operators.changes import DELTA, changed_rows
from greenledger.operators.dims import ReportingWindow
from greenledger.plans import incremental
from greenledger.plans.pipeline import ReportingBuild, ReportingParams
from greenledger.plans.publish import Publication, publish_build
from greenledger.session import written
from greenledger.sources.raw import RAW_COLUMNS, string_schema

PARAMS = ReportingParams(window=ReportingWindow("2024-01", 24))
NAMES = [*checks.REQUIRED_MARTS, *checks.KPI_CONTRACT, "dq_report", "dq_quarantine"]
CODES = [("SCOPE1_GHG", "t"), ("SCOPE2_GHG", "kg"), ("ENERGY_CONS", "kWh"), ("HOURS_WORKED", "hours")]


def tables(spark, raw):
    """Every table of a full build, each layer written once."""
    b = ReportingBuild(spark, raw, PARAMS, materialize=lambda name, df: written(df, name))
    return b.marts() | b.kpi_tables() | {"dq_report": b.dq_report, "dq_quarantine": b.dq_quarantine}


def plain(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def random_readings(rng, n):
    """Monthly readings of a few sites with dirt, ids that repeat and resubmissions."""
    out = []
    for i in range(n):
        code, uom = rng.choice(CODES)
        out.append(reading(
            rng.choice((i, i, i, i - 1, None)), site=rng.choice(("201", "203", "207", "999")),
            period=f"{rng.choice((2024, 2025))}-{rng.randint(1, 12):02d}" if rng.random() < 0.97 else "soon", code=code,
            value=rng.choice(("4", "17", "60", "x", "-3")) if rng.random() < 0.3 else str(rng.randint(1, 90)),
            uom=uom if rng.random() < 0.95 else "lb", submitted=f"2025-12-{rng.randint(1, 28):02d} 08:00:00"))
    return out


def random_incidents(rng, n):
    return [(str(rng.randint(1, n)), rng.choice(("201", "203", "207")), f"{rng.choice((2024, 2025))}-{rng.randint(1, 12):02d}-11", "Fall",
             "Low", rng.choice("YN"), str(rng.randint(0, 9)), rng.choice(("EHS Officer", "Lead"))) for _ in range(n)]


def mutated(rng, rows, fresh, share):
    """Some rows gone, some altered, some doubled, some new."""
    out = []
    for r in rows:
        x = rng.random()
        if x < share / 3:
            continue
        out.append(fresh[rng.randrange(len(fresh))] if x < 2 * share / 3 else r)
        if x > 1 - share / 6:
            out.append(r)
    return out + rng.sample(fresh, max(1, int(share * 10)))


def snapshot(fixture_refs, spark, readings, incidents):
    raw = fixture_raw(fixture_refs, spark, [])
    return raw | {"readings": spark.createDataFrame(readings, string_schema(READING_COLS)),
                  "incidents": spark.createDataFrame(incidents, string_schema(RAW_COLUMNS["incidents"]))}


@pytest.mark.parametrize("seed", range(2))
def test_an_increment_is_a_full_build(spark, fixture_refs, seed):
    rng = random.Random(seed)
    readings, incidents = random_readings(rng, 240), random_incidents(rng, 40)
    share = (0.03, 0.3)[seed]
    old = snapshot(fixture_refs, spark, readings, incidents)
    new = snapshot(fixture_refs, spark, mutated(rng, readings, random_readings(rng, 60), share),
                   mutated(rng, incidents, random_incidents(rng, 20), share))
    base, full = tables(spark, old), tables(spark, new)
    updates = incremental.incremental_update(old, new, base, PARAMS)
    for name in NAMES:
        got = incremental.applied(base[name], updates[name], name) if name in updates else base[name]
        assert plain(got.select(*full[name].columns)) == plain(full[name]), name


def clean(periods=range(1, 13), value="3"):
    return [reading(f"{s}{m}{k}", site=s, period=f"2024-{m:02d}", code=c, value=value, uom=u)
            for s in ("201", "207") for m in periods for k, (c, u) in enumerate(CODES)]


def test_only_touched_months_are_written(spark, fixture_refs, tmp_path):
    rows = clean()
    corrected = [r if (r[0], r[3]) != ("20150", "SCOPE1_GHG") else (*r[:4], "50", *r[5:]) for r in rows]
    old, new = (fixture_raw(fixture_refs, spark, x) for x in (rows, corrected))
    root = str(tmp_path)
    first = publish_build(spark, old, root, PARAMS)
    second = incremental.publish_increment(spark, old, new, root, PARAMS)
    reader = Publication(spark, root)

    def fresh(name):
        return {p for p, f in second.tables[name].items() if first.tables[name].get(p) != f}

    # May was corrected; a quarter reported for May would also feed March and April
    assert fresh("fact_eqs_monthly") == {"202403", "202404", "202405"}
    assert fresh("kpi_emissions") == fresh("kpi_energy_intensity") == {"2024-03", "2024-04", "2024-05"}
    assert fresh("kpi_trir") == {f"{2024 + m // 12}-{m % 12 + 1:02d}" for m in range(2, 16)}
    assert fresh("kpi_yoy") == {f"{y}-{m:02d}" for y in (2024, 2025) for m in (3, 4, 5)}
    assert fresh("fact_incident") == set() and fresh("dim_site") == set()
    full = tables(spark, new)
    for name in NAMES:
        assert plain(reader.table(name).select(*full[name].columns)) == plain(full[name]), name
        assert second.rows[name] == len(plain(full[name])), name
    assert {r.scope1_tco2e for r in reader.table("kpi_emissions", version=1).where("period = '2024-05'").collect()} == {3.0, None}
    third = incremental.publish_increment(spark, new, new, root, PARAMS)  # no change writes no month
    assert all(third.tables[n] == second.tables[n] for n in [*checks.REQUIRED_MARTS, *checks.KPI_CONTRACT])


def test_a_catalogue_change_is_a_full_build(spark, fixture_refs):
    old = fixture_raw(fixture_refs, spark, clean(range(1, 3)))
    new = old | {"sites": old["sites"].where("site_id <> '203'")}
    assert incremental.incremental_update(old, new, {}, PARAMS) is None


def test_a_touched_month_with_a_double_key_is_not_published(spark, fixture_refs, tmp_path):
    old = fixture_raw(fixture_refs, spark, clean(range(1, 3)))
    new = fixture_raw(fixture_refs, spark, clean(range(1, 3)) + [reading(777, period="2024-03", ptype="Q")])
    publish_build(spark, old, str(tmp_path), PARAMS)
    with pytest.raises(checks.ContractError):
        incremental.publish_increment(spark, old, new, str(tmp_path), PARAMS)
    assert Publication(spark, str(tmp_path)).versions() == [1]


def test_changed_rows_are_a_multiset_difference(spark):
    schema = "a string, b string"
    old = spark.createDataFrame([("x", None), (None, "x"), ("y", "1"), ("y", "1"), ("z", "")], schema)
    new = spark.createDataFrame([("x", None), ("y", "1"), ("z", None), ("w", "2"), ("w", "2")], schema)
    got = {(r.a, r.b): r[DELTA] for r in changed_rows(old, new).collect()}
    assert got == {(None, "x"): -1, ("y", "1"): -1, ("z", ""): -1, ("z", None): 1, ("w", "2"): 2}
    assert changed_rows(old, old).isEmpty()
