"""Summarise the final (AQE) physical plan of every registered query.

usage: python scripts/plan_report.py [sf_dir] > PLANS.md
Counts shuffles, broadcasts, join kinds, windows and Python stages in the
plan Spark actually ran, and lists the columns each Parquet scan read.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyfold.plans.catalog import QUERIES  # noqa: E402
from tallyfold.session import build_session  # noqa: E402

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "nested-loop/cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "windows": r"\bWindow\b",
    "python": r"ArrowEvalPython|MapInPandas|BatchEvalPython",
}


def final_only(plan: str) -> str:
    """Drop every "Initial Plan" subtree of an adaptive plan's text, so only the
    plan that ran is counted (nested subqueries carry their own sections)."""
    out, skip_below = [], None
    for line in plan.splitlines():
        m = re.search(r"[A-Za-z=*(]", line)
        indent = m.start() if m else len(line)
        if skip_below is not None:
            if indent > skip_below:
                continue
            skip_below = None
        if "== Initial Plan ==" in line:
            skip_below = line.index("+-")  # children sit to the right of the branch
            continue
        out.append(line)
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    print(f"# Physical plans (final AQE plans, {sf}, local[8], 16 shuffle partitions)\n")
    print("Generated by `scripts/plan_report.py`. Counts are operators in the final plan Spark ran "
          "for the query's last action (eager steps ran as their own jobs before it).\n")
    print("| query | " + " | ".join(PATTERNS) + " | parquet columns read |")
    print("| --- | " + " | ".join("---" for _ in PATTERNS) + " | --- |")
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        plan = final_only(df._jdf.queryExecution().executedPlan().toString())
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
        cols = sorted({c.strip().split("#")[0] for s in scans for c in s.split(",") if c.strip()})
        print(f"| {name} | " + " | ".join(counts) + f" | {', '.join(cols)} |")
    spark.stop()


if __name__ == "__main__":
    main()
