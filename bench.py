"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

After a JIT warm-up pass over the smallest data set, each query is built
and fully executed into Spark's ``noop`` sink (no collect), once cold and
``BENCH_REPEAT`` times warm; the reported time per
query is the best warm run and includes any eager work done while the plan
is built (the checked-broadcast materializations); ``build`` is that
plan-building part alone.  ``jobs`` counts the Spark jobs of the best warm
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINE = [
    "features_all",
    "features_all_lazy",
    "features_sector",
    "features_sector_window",
    "null_profile",
    "distinct_profile",
    "numeric_profile",
    "key_profile",
    "feature_stats",
    "quality_report",
    "stage_audit",
    "profile_shape",
    "flows_by_destination",
    "csv_roundtrip",
]


def run_once(spark, fn, sf_dir: str, group: str) -> tuple[float, int, float]:
    """(total seconds, Spark jobs, seconds spent building the plan incl. eager checks)."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    t0 = time.perf_counter()
    df = fn(spark, sf_dir)
    t1 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t0
    jobs = len(sc.statusTracker().getJobIdsForGroup(group))
    sc.setJobGroup("idle", "idle")
    return elapsed, jobs, t1 - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from fundlens.plans.queries import QUERIES
    from fundlens.session import local_session

    spark = local_session(
        cpus,
        shuffle_partitions=max(8, 2 * cpus),
        app_name="fundlens-bench",
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    names = only or HEADLINE
    # JIT warm-up on the smallest data set, so "cold" means a first run over
    # this data set rather than a fresh JVM.
    warmup_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warmup_dir) and warmup_dir.rstrip("/") != sf_dir:
        for name in names:
            run_once(spark, QUERIES[name], warmup_dir, f"{name}-warmup")
    cold, warm, jobs, build = {}, {}, {}, {}
    for name in names:
        fn = QUERIES[name]
        cold[name] = round(run_once(spark, fn, sf_dir, f"{name}-cold")[0], 3)
        best = None
        for i in range(repeat):
            t, n_jobs, b = run_once(spark, fn, sf_dir, f"{name}-warm{i}")
            if best is None or t < best[0]:
                best = (t, n_jobs, b)
        warm[name], jobs[name], build[name] = round(best[0], 3), best[1], round(best[2], 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "headline_queries_total_warm",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "build": build,
        "jobs": jobs,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
