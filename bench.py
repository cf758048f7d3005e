"""Benchmark: the end-to-end reporting build at one scale factor.

Runs raw -> quality -> staging -> marts -> KPIs -> reports on the adapter
tables of ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``. Shared layers are written as Parquet tables (as a
production run would) and every layer is timed on its own. The build runs
twice in one session: ``cold`` is the first run, with the JVM still compiling
the generated code, and ``value`` the second. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from greenledger.operators import checks  # noqa: E402
from greenledger.plans.pipeline import REPORT_ORDER, ReportingBuild, TableStore  # noqa: E402
from greenledger.plans.registry import ADAPTER_PARAMS  # noqa: E402
from greenledger.session import local_session, scratch_path  # noqa: E402
from greenledger.sources import adapter  # noqa: E402
from greenledger.sources.sinks import export_report  # noqa: E402


def run_build(spark, sf_dir: str, out: str, timed) -> None:
    """The whole build, every layer through ``timed(name, thunk)``."""
    store = TableStore(spark, f"{out}/tables")
    raw = timed("adapter", lambda: adapter.raw_tables(spark, sf_dir))
    b = ReportingBuild(spark, raw, ADAPTER_PARAMS, materialize=store)
    timed("dq_report", lambda: b.dq_report.collect())
    timed("dq_quarantine", lambda: b.dq_quarantine)
    timed("stg_readings", lambda: b.stg_readings)
    timed("stg_incidents", lambda: b.stg_incidents)
    timed("dims", b.dims)
    timed("fact_monthly", lambda: b.fact_monthly)
    timed("fact_incident", lambda: b.fact_incident)
    timed("active_spine", lambda: b.active_spine)
    timed("kpi_emissions", lambda: b.kpi_emissions)
    for name in ("kpi_energy_intensity", "kpi_trir", "kpi_yoy"):
        timed(name, lambda n=name: export_report(getattr(b, n), checks.KPI_CONTRACT[n],
                                                 f"{out}/reports/{n}", REPORT_ORDER[n]))
    timed("export_emissions", lambda: export_report(
        b.kpi_emissions, checks.KPI_CONTRACT["kpi_emissions"],
        f"{out}/reports/kpi_emissions", REPORT_ORDER["kpi_emissions"]))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    extra = {}
    for item in filter(None, os.environ.get("BENCH_CONF", "").split(",")):
        key, _, value = item.partition("=")  # extra session settings, k=v,k=v
        extra[key.strip()] = value.strip()
    if os.environ.get("BENCH_EVENTLOG"):  # stage/task timings for offline analysis
        extra = {"spark.eventLog.enabled": "true",
                 "spark.eventLog.dir": os.environ["BENCH_EVENTLOG"], **extra}
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="greenledger-bench", extra=extra)
    scratch = scratch_path(spark, "bench")  # under the session's checkpoint folder
    timings: dict[str, float] = {}
    jobs: dict[str, int] = {}
    tracker = spark.sparkContext.statusTracker()

    def timed(name, fn):
        spark.sparkContext.setJobGroup(name, name)
        t = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t, 3)
        jobs[name] = len(tracker.getJobIdsForGroup(name))
        return out

    # One large row group is read by one task whatever the split size; deal the
    # fact tables out to the cores, as many files or row groups would be.
    spark.conf.set(adapter.DEAL_OUT, cpus if cpus.isdigit() else "8")
    t0 = time.perf_counter()
    run_build(spark, sf_dir, f"{scratch}/cold", lambda name, fn: fn())
    cold = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    run_build(spark, sf_dir, f"{scratch}/run", timed)
    total = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "reporting_build_wall_time", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cold": cold}))
    if os.environ.get("BENCH_JOBS"):
        print(json.dumps({"spark_jobs": jobs}), file=sys.stderr)
    spark.stop()


if __name__ == "__main__":
    main()
