"""What one task sorts and holds does not grow with the input, and the ledger moves each row once."""

import contextlib
import io

import pytest
from helpers import fixture_raw, reading

from greenledger import session
from greenledger.operators.dims import ReportingWindow
from greenledger.plans import pipeline
from greenledger.plans.pipeline import ReportingBuild, ReportingParams

PARAMS = ReportingParams(window=ReportingWindow("2024-01", 24))
FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


@pytest.fixture
def settings(spark):
    """The session's settings, put back after the test."""
    was = {name: spark.conf.get(name, None) for name in (FIRST, *SIZES)}
    spark.conf.unset(FIRST)
    yield spark.conf
    for name, value in was.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_shuffles_are_cut_by_the_bytes_of_the_input(spark, settings, fixture_refs, monkeypatch):
    monkeypatch.setattr(session, "PARTITION_BYTES", 64)
    size = session.input_bytes(fixture_refs["incidents"])
    assert size > 64 * 8
    settings.set(SIZES[0], "128MB")
    settings.set(SIZES[1], "64m")
    ReportingBuild(spark, fixture_raw(fixture_refs, spark, [reading(1)]), PARAMS)
    assert int(settings.get(FIRST)) == -(-size // 64)
    assert {session._bytes(settings.get(name)) for name in SIZES} == {session.TASK_BYTES}


def test_settings_for_smaller_tasks_stay(spark, settings, fixture_refs, monkeypatch):
    monkeypatch.setattr(session, "PARTITION_BYTES", 64)
    settings.set(FIRST, "5000")
    for name in SIZES:
        settings.set(name, "1m")
    ReportingBuild(spark, fixture_raw(fixture_refs, spark, [reading(1)]), PARAMS)
    assert settings.get(FIRST) == "5000" and {settings.get(name) for name in SIZES} == {"1m"}


def test_partitions_of_one_large_key_are_split(spark, fixture_refs):
    """Readings have few units: the partition of one of them is split from a few tasks' bytes on."""
    name = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    was = spark.conf.get(name)
    try:
        for before, after in (("256MB", session.SKEWED_BYTES), ("1m", 1 << 20)):
            spark.conf.set(name, before)
            ReportingBuild(spark, fixture_raw(fixture_refs, spark, [reading(1)]), PARAMS)
            assert session._bytes(spark.conf.get(name)) == after
        assert session.SKEWED_BYTES == 4 * session.TASK_BYTES
    finally:
        spark.conf.set(name, was)


def test_bytes_count_each_file_once(spark, tmp_path):
    path = str(tmp_path / "rows with blanks")
    spark.range(1000).repartition(3).write.parquet(path)
    rows, size = spark.read.parquet(path), sum(p.stat().st_size for p in (tmp_path / "rows with blanks").glob("*.parquet"))
    assert session.input_bytes(rows) == session.input_bytes(rows, rows.join(rows.toDF("i"), rows["id"] == rows["id"], "left_semi")) == size
    assert session.input_bytes(spark.range(3)) == 0


def test_the_ledger_moves_raw_rows_once(spark, fixture_refs, monkeypatch):
    names, write = [], session.written

    def noted(df, name):
        names.append(name)
        return write(df, name)

    monkeypatch.setattr(pipeline, "written", noted)
    raw = fixture_raw(fixture_refs, spark, [reading(i, value="x" if i == 4 else "1") for i in (1, 2, 3, 4, 4)])
    ledger = ReportingBuild(spark, raw, PARAMS).row_ledger
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        ledger.explain()
    assert "hashpartitioning(reading_id" not in buf.getvalue()  # the one join by id is written
    assert names == ["numbered-readings", "numbered-incidents"]  # readings are numbered with their flags
