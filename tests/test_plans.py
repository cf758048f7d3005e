"""Physical plans keep the shapes that scale, for every registered query: no
nested-loop or cartesian join, one task only above a partial aggregate, no
plan that folds a frame into one partition, pruned scans."""

import contextlib
import io
import re

import pytest
from helpers import SF_SMALL, have_testdata
from pyspark.sql import Window
from pyspark.sql import functions as F

from greenledger.plans import registry

pytestmark = pytest.mark.skipif(not have_testdata(SF_SMALL), reason="no test data")


def _plan(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()  # the plain plan: operators with their arguments, children indented below
    return [x for x in buf.getvalue().splitlines() if x.strip()]


def faults(plan: list[str]) -> list[str]:
    found = [x for x in plan if re.search("BroadcastNestedLoopJoin|CartesianProduct", x)]
    for line, below in zip(plan, plan[1:] + [""]):
        if "Exchange SinglePartition" in line and "partial_" not in below:
            found.append(f"{line.strip()} above {below.strip()}")
        # a report of one row per rule, the explode of one row of totals, may be put in order by one task
        if re.search(r"Coalesce 1\b", line) and not any("Generate explode" in x for x in plan[plan.index(line):][:4]):
            found.append(line.strip())
    return found


# Queries that run to their end when they are built; what they return only reads what they wrote.
EAGER = {"publication", "incremental_build", "event_time_latest"}


@pytest.mark.parametrize("key", sorted(set(registry.queries()) - EAGER))
def test_no_operator_that_does_not_scale(spark, key):
    assert faults(_plan(registry.queries()[key](spark, SF_SMALL))) == []


def test_the_check_can_fail(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    assert faults(_plan(df.withColumn("n", F.row_number().over(Window.orderBy("v")))))
    assert faults(_plan(df.crossJoin(df.withColumnRenamed("id", "j").select("j"))))
    assert faults(_plan(df.coalesce(1).sortWithinPartitions("v")))
    assert not faults(_plan(df.agg(F.sum("v"))))


def test_scans_are_pruned_and_few(spark):
    plan = _plan(registry.queries()["dq_report"](spark, SF_SMALL))
    scans = [x for x in plan if "FileScan parquet" in x and "l_orderkey" in x]
    assert len(scans) == 1
    assert "l_extendedprice" not in scans[0] and "l_discount" not in scans[0]


def test_building_a_query_reads_no_fact_table(spark):
    """Building a query starts no job beyond those that read the tables' schemas
    and, where surrogate keys are needed, those that write the keyed dimensions."""
    from greenledger.sources import adapter

    sc = spark.sparkContext

    def jobs(name, run):
        sc.setJobGroup(name, name)
        run()
        return len(sc.statusTracker().getJobIdsForGroup(name))

    schemas = jobs("schemas", lambda: adapter.raw_tables(spark, SF_SMALL))
    for key, more in (("latest_submission", 0), ("dq_report", 0), ("conform_uom", 0), ("kpi_trir", 20)):
        n = jobs(f"build-{key}", lambda k=key: registry.queries()[k](spark, SF_SMALL))
        assert n <= schemas + more, (key, n)
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_an_increment_scans_and_joins_without_nested_loops(spark):
    """The frames of the increment that read whole snapshots."""
    from greenledger.operators.changes import changed_rows
    from greenledger.plans import incremental
    from greenledger.sources import adapter

    new = adapter.raw_tables(spark, SF_SMALL)
    old = adapter.before_corrections(new)
    changes = changed_rows(old["readings"], new["readings"])
    cells = incremental.touched_cells(old["readings"], new["readings"], changes)
    for df in (changes, cells, incremental.readings_of(new["readings"], cells)):
        assert faults(_plan(df)) == []


def test_a_single_rule_joins_what_it_asks_only(spark):
    plan = "\n".join(_plan(registry.queries()["dq_numeric"](spark, SF_SMALL)))
    assert "part.parquet" not in plan and "nation.parquet" not in plan
