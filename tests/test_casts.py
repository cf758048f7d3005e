"""Safe casts agree with the SQL dialect the oracle runs (DuckDB)."""

import math

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from greenledger.functions import (duck_bigint, duck_date, duck_double, duck_int,
                                   duck_timestamp, month_start_of_period, ztrim)

NUMBERS = ["1", "1.5", "2.5", "-2.5", " 5 ", "1d", "1_000", "1,000", "", "nan", "NaN", "inf",
           "-inf", "Infinity", "1e3", "1E-2", ".5", "5.", "+3", "--3", "0x10", "\t7\t", "7\r",
           "\xa07", "1 000", "1__0", "_1", "1_", "n/a", "-12", "- 12", "1e", "9999999999",
           "2147483648", "-2147483648", "101", None, "-0", "00012", "1e400"]
DATES = ["2024-01-01", "2024-1-5", "2024-01", "2024", "2024-01-05 10:00:00", " 2024-01-05 ",
         "2024-02-30", "2024-13-01", "24-01-01", "2024/01/05", "2024-01-05T10:00",
         "bad-01", "20240105", "2024-Q1-01", "2024-01-05 ", "2024-01-05x", "\xa02024-01-05",
         "2024-01-05 08:00:00.123", "2024-01-05 24:00:00", "12:30", "not-a-date",
         "2024-01-05 08:00:00+02", "2024-01-05 08:00:00Z", " 2024-01-05 08:00:00 ",
         "2024-01-05 08", "2024-01-05 25:00:00", "2024-01-05  08:00:00", None]


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b


def _check(spark, values, spark_fns, sql):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", *[f("v").alias(f"c{i}") for i, f in enumerate(spark_fns)]).collect()
    con = duckdb.connect()
    bad = []
    for r in got:
        want = con.execute(sql, [r.v] * sql.count("?")).fetchone()
        mine = tuple(r[f"c{i}"] for i in range(len(spark_fns)))
        if not all(_same(a, b) for a, b in zip(mine, want)):
            bad.append((r.v, mine, want))
    assert not bad, bad


def test_numeric_casts_match_dialect(spark):
    _check(spark, NUMBERS, [duck_double, duck_int, duck_bigint],
           "select try_cast(?::varchar as double), try_cast(?::varchar as integer), "
           "try_cast(?::varchar as bigint)")


def test_date_and_timestamp_casts_match_dialect(spark):
    _check(spark, DATES, [duck_date, duck_timestamp],
           "select try_cast(?::varchar as date), try_cast(?::varchar as timestamp)")


def test_period_month_start(spark):
    periods = ["2024-01", "2024-1", "2024", "2024-Q1", None, " 2024-03", "2024-13", "bad"]
    _check(spark, periods, [month_start_of_period],
           "select try_cast(?::varchar || '-01' as date)")


def test_trim_strips_unicode_spaces_only(spark):
    values = [" a ", "\xa0a\xa0", " a", "\ta\t", "a\r", "　a", None]
    _check(spark, values, [ztrim], "select trim(?::varchar)")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="0123456789-_.eE+ /:T", max_size=12), min_size=1,
                max_size=30))
def test_random_strings_match_dialect(spark, values):
    _check(spark, values, [duck_double, duck_bigint, duck_date, duck_timestamp],
           "select try_cast(?::varchar as double), try_cast(?::varchar as bigint), "
           "try_cast(?::varchar as date), try_cast(?::varchar as timestamp)")
