"""The ledger of restated values, and replaying it."""

import random

from greenledger.operators import changes

SCHEMA = "period string, unit string, a double, b double, note string"
KEYS, MEASURES = ["period", "unit"], ["a", "b"]


def frame(spark, rows):
    return spark.createDataFrame([(*k, *v, "n") for k, v in rows.items()], SCHEMA)


def test_kinds(spark):
    old = {("1", None): (1.0, None), ("1", "x"): (2.0, 3.0), ("2", "x"): (None, None), ("3", "x"): (5.0, 6.0), (None, None): (7.0, 0.0)}
    new = {("1", None): (1.0, 4.0), ("1", "x"): (2.5, 3.0), ("2", "x"): (None, None), ("4", "x"): (8.0, None), (None, None): (None, 0.0)}
    got = {tuple(r) for r in changes.restatement_ledger(frame(spark, old), frame(spark, new), KEYS, MEASURES).collect()}
    assert got == {("1", None, "b", "FIRST", None, 4.0), ("1", "x", "a", "CHANGED", 2.0, 2.5), ("3", "x", "a", "WITHDRAWN", 5.0, None),
                   ("3", "x", "b", "WITHDRAWN", 6.0, None), ("4", "x", "a", "FIRST", None, 8.0), (None, None, "a", "WITHDRAWN", 7.0, None)}
    assert changes.restatement_ledger(frame(spark, old), frame(spark, old), KEYS, MEASURES).count() == 0
    assert changes.restatement_ledger(frame(spark, {}), frame(spark, {}), KEYS, MEASURES).count() == 0


def test_replaying_the_ledgers_gives_each_version(spark):
    rng = random.Random(3)

    def version():
        return {(str(p), u): tuple(rng.choice((None, 0.0, float(rng.randint(1, 5)))) for _ in MEASURES)
                for p in range(6) for u in ("x", "y", None) if rng.random() < 0.8}

    versions = [frame(spark, version()) for _ in range(4)]
    ledgers = [changes.restatement_ledger(a, b, KEYS, MEASURES) for a, b in zip(versions, versions[1:])]
    start = changes.long_values(versions[0], KEYS, MEASURES)
    for k in range(4):
        got = changes.replayed(start, ledgers[:k], KEYS)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, changes.long_values(versions[k], KEYS, MEASURES).collect()))
