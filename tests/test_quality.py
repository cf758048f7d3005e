"""Data-quality rules: one pass, rules as data, quarantine and exclusion."""

from helpers import fixture_raw, reading

from greenledger.operators import quality as q


def _report(raw):
    flagged = q.flag_readings(raw["readings"], raw)
    rep = {r.rule_id: r for r in q.dq_report(flagged).collect()}
    return flagged, rep


def test_clean_readings_give_empty_but_typed_quarantine(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [reading(1), reading(2, code="SCOPE2_GHG")])
    flagged, rep = _report(raw)
    quarantine = q.dq_quarantine(flagged)
    assert quarantine.columns == q.QUARANTINE_COLUMNS
    assert quarantine.count() == 0
    assert all(r.rows_failed == 0 and r.action_taken == "NONE" for r in rep.values())
    assert [r.rule_id for r in q.dq_report(flagged).collect()] == \
        [r.rule_id for r in q.DEFAULT_RULES]


def test_empty_readings(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [])
    flagged, rep = _report(raw)
    assert q.dq_quarantine(flagged).count() == 0
    assert all(r.rows_checked == 0 for r in rep.values())


def test_row_failing_two_rules_is_quarantined_twice_and_excluded_once(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [
        reading(1, value="abc", ptype="X"),          # DQ001 + DQ008
        reading(2),
    ])
    flagged, rep = _report(raw)
    quarantine = q.dq_quarantine(flagged)
    assert sorted(r.rule_id for r in quarantine.collect()) == ["DQ001", "DQ008"]
    kept = q.quarantine_exclusion(raw["readings"], quarantine)
    assert [r.reading_id for r in kept.collect()] == ["2"]
    assert rep["DQ001"].action_taken == "QUARANTINE"


def test_duplicate_id_with_one_bad_copy_excludes_both(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [
        reading(5), reading(5, value="-3"), reading(6)])
    flagged, rep = _report(raw)
    assert rep["DQ006"].rows_failed == 1
    kept = q.quarantine_exclusion(raw["readings"], q.dq_quarantine(flagged))
    assert [r.reading_id for r in kept.collect()] == ["6"]


def test_null_reading_id_is_counted_but_not_excluded(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [reading(None, value="oops"), reading(7)])
    flagged, rep = _report(raw)
    assert rep["DQ001"].rows_failed == 1
    kept = q.quarantine_exclusion(raw["readings"], q.dq_quarantine(flagged))
    assert kept.count() == 2


def test_rules_compare_raw_untrimmed_values(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [
        reading(1, code="ENERGY_CONS", uom=" MWh "),    # DQ004: raw unit unknown
        reading(2, ptype="m"),                          # DQ008: lower case
        reading(3, code=" SCOPE1_GHG"),                 # DQ003 (and DQ004 n/a)
        reading(4, site="999"),                         # DQ002, DQ005 out of scope
    ])
    _, rep = _report(raw)
    assert rep["DQ004"].rows_failed == 1
    assert rep["DQ008"].rows_failed == 1
    assert rep["DQ003"].rows_failed == 1
    assert rep["DQ002"].rows_failed == 1
    assert rep["DQ005"].rows_checked == 3


def test_validity_rule_month_truncated_and_unparseable_period_passes(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [
        reading(1, site="207", period="2025-02"),   # month of divestment: inside
        reading(2, site="207", period="2025-03"),   # after: outside
        reading(3, site="211", period="2024-07"),   # before acquisition: outside
        reading(4, site="211", period="2024-08"),
        reading(5, site="211", period="bad"),       # no rule catches it
    ])
    _, rep = _report(raw)
    assert rep["DQ005"].rows_checked == 5
    assert rep["DQ005"].rows_failed == 2


def test_multiple_submissions_counts_every_row_and_ignores_null_keys(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [
        reading(1), reading(2), reading(3),                        # group of 3
        reading(4, period=None), reading(5, period=None),          # NULL key: no match
        reading(6, code="SCOPE2_GHG"),
    ])
    _, rep = _report(raw)
    assert rep["DQ007"].rows_failed == 3
    assert rep["DQ007"].action_taken == "FLAG"
    dup = q.duplicate_submissions(raw["readings"]).collect()
    assert sorted(r.reading_id for r in dup) == ["1", "2", "3"]
    assert {r.group_rows for r in dup} == {3}


def test_unit_rule_counts_lookup_fan_out(spark, fixture_refs):
    """A duplicated conversion row is counted twice in rows_checked, like
    the left-join formulation of the rule."""
    raw = fixture_raw(fixture_refs, spark, [reading(1, code="ENERGY_CONS", uom="kWh"),
                                            reading(2, code="UNDEFINED", uom="kWh")])
    conv = raw["uom_conversions"]
    raw["uom_conversions"] = conv.unionByName(conv.where("from_uom = 'kWh'"))
    _, rep = _report(raw)
    assert rep["DQ004"].rows_checked == 3
    assert rep["DQ004"].rows_failed == 0


def test_gate_blocks_only_on_block_action(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [reading(1, value="x")])
    flagged = q.flag_readings(raw["readings"], raw)
    assert not q.has_blocking_failures(q.dq_report(flagged))
    blocking = tuple(q.Rule(r.rule_id, r.rule_name, r.severity,
                            "BLOCK" if r.rule_id == "DQ001" else r.action, r.check, r.reason)
                     for r in q.DEFAULT_RULES)
    flagged = q.flag_readings(raw["readings"], raw, blocking)
    gate = q.dq_gate(q.dq_report(flagged, blocking)).first()
    assert gate.is_blocked and gate.blocking_rules == 1


def test_any_version_and_period_rules(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [
        reading(1, period="2024-06"), reading(2, period="2025-06"), reading(3, period="2030-01"),
        reading(4, period="soon"), reading(5, site="999", period="2024-06")])
    sites = raw["sites"]
    row = sites.where("site_id = '201'")
    raw["sites"] = sites.where("site_id <> '201'").unionByName(
        row.selectExpr(*[c for c in sites.columns if c != "valid_to"], "'2024-12-31' AS valid_to")).unionByName(
        row.selectExpr(*[c for c in sites.columns if not c.startswith("valid")], "'2025-01-01' AS valid_from",
                       "'2025-12-31' AS valid_to"))
    counts = {}
    for name, rules in (("each", q.DEFAULT_RULES), ("any", (q.ANY_VERSION_RULE, q.PERIOD_RULE))):
        flagged = q.flag_readings(raw["readings"], raw, rules)
        counts[name] = {r.rule_id: (r.rows_checked, r.rows_failed) for r in q.dq_report(flagged, rules).collect()}
    assert counts["each"]["DQ005"] == (8, 4)          # two versions a reading; the third is outside of both
    assert counts["any"] == {"DQ005": (4, 1), "DQ010": (5, 1)}


def test_kept_readings_are_those_of_the_exclusion(spark, fixture_refs):
    raw = fixture_raw(fixture_refs, spark, [
        reading(1), reading(1, value="x"), reading(2), reading(None, value="x"), reading(None), reading(3, ptype="Z")])
    flagged = q.flag_readings(raw["readings"], raw)
    kept = q.kept_readings(flagged, raw["readings"].columns)
    want = q.quarantine_exclusion(raw["readings"], q.dq_quarantine(flagged))
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, want.collect())) and kept.count() == 3
