"""Every registered query against its SQL oracle (DuckDB), the way the
driver compares them: row count, column names, order-insensitive values.
All keys run."""

import pytest
from helpers import SF_SMALL, have_testdata

import __spark_entry__ as entry_module
from greenledger.plans import oracle, registry
from oracle_compare import compare, duck_connection

pytestmark = pytest.mark.skipif(not have_testdata(SF_SMALL), reason="no test data")

KEYS = sorted(registry.queries())


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(entry_module.queries())


@pytest.fixture(scope="module")
def con():
    c = duck_connection(SF_SMALL)
    yield c
    c.close()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry_module.queries()[key](spark, SF_SMALL)
    result = compare(key, df, con, entry_module.oracle_sql()[key])
    assert result.ok, result


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["period", "site_id", "site_name", "recordable_incidents_r12",
                          "hours_worked_r12", "trir_r12", "has_full_window"]
    assert df.count() >= 0
