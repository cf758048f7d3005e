"""Constants and row builders that the tests share (a module of its own name: a
second conftest.py further down would shadow an import of ``conftest``)."""

from __future__ import annotations

import os
from pathlib import Path

FIXTURES = Path(__file__).resolve().parent / "fixtures"
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def have_testdata(sf_dir: str) -> bool:
    return os.path.exists(os.path.join(sf_dir, "lineitem.parquet"))


READING_COLS = ["reading_id", "site_id", "period", "metric_code", "value", "uom",
                "period_type", "source_system", "submitted_at"]


def reading(rid, site="201", period="2024-01", code="SCOPE1_GHG", value="10", uom="t",
            ptype="M", submitted="2024-02-05 08:00:00", source="PORTAL"):
    """One raw reading row (all strings, None allowed)."""
    return (None if rid is None else str(rid), site, period, code, value, uom, ptype, source,
            submitted)


def readings_frame(spark, rows):
    from greenledger.sources.raw import string_schema

    return spark.createDataFrame(list(rows), string_schema(READING_COLS))


def fixture_raw(fixture_refs, spark, rows):
    raw = dict(fixture_refs)
    raw["readings"] = readings_frame(spark, rows)
    return raw
