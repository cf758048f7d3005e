from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from helpers import FIXTURES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from greenledger.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="greenledger-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixtures_dir() -> Path:
    return FIXTURES


@pytest.fixture(scope="session")
def fixture_refs(spark):
    """Sites, metrics, units and incidents ingested from the CRLF fixtures."""
    from greenledger.sources.raw import RAW_COLUMNS, ingest_raw

    return {name: ingest_raw(spark, str(FIXTURES / f"{name}.csv"), RAW_COLUMNS[name])
            for name in ("sites", "metric_definitions", "uom_conversions", "incidents")}
