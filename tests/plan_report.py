"""Write PLANS.md: the final adaptive plan of every registered query, summarized.

    python tests/plan_report.py /root/testdata/sf0.01 > PLANS.md

Each query is executed once; its final physical plan (after AQE) is scanned
for the operators that matter at scale.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

OPS = [
    ("shuffle", r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin"),
    ("single-partition", r"Exchange SinglePartition"),
    ("broadcast", r"BroadcastExchange"),
    ("broadcast join", r"BroadcastHashJoin"),
    ("sort-merge join", r"SortMergeJoin"),
    ("window", r"\bWindow\b"),
    ("expand", r"\bExpand\b"),
    ("top-n", r"TakeOrderedAndProject"),
    ("parquet scans", r"FileScan parquet|Scan parquet"),
    ("csv scans", r"FileScan csv|Scan csv"),
    ("materialized scans", r"Scan ExistingRDD"),
]


def main(sf_dir: str) -> None:
    import __spark_entry__ as entry
    from fundlens.session import local_session

    spark = local_session(8, 8)
    print("# Final plans of the registered queries\n")
    print(
        f"Generated by `tests/plan_report.py` at `{sf_dir}`: each query is executed once and its final "
        "adaptive plan (after AQE re-planning) is scanned.  *materialized scans* read tables that the "
        "query checkpointed while it was built (checked broadcasts, a derived base); their own small jobs "
        "are not in this plan.  Counts are operators in the final plan, not runs.\n"
    )
    print("| query | " + " | ".join(name for name, _ in OPS) + " |")
    print("| --- | " + " | ".join("---" for _ in OPS) + " |")
    for name, fn in entry.queries().items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        qe = df._jdf.queryExecution().executedPlan()
        try:
            plan = qe.executedPlan().toString()  # final plan of an adaptive query
        except Exception:  # noqa: BLE001 - non-adaptive plan
            plan = qe.toString()
        counts = [len(re.findall(pattern, plan)) for _, pattern in OPS]
        print(f"| `{name}` | " + " | ".join(str(c) if c else "" for c in counts) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
