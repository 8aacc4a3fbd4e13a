"""Benchmark: run every registered query over whole tables, print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is executed in full with the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyfold.plans.catalog import QUERIES  # noqa: E402
from tallyfold.session import build_session, scratch_run  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = set(sys.argv[1:])
    spark = build_session(f"local[{cpus}]", app="tallyfold-bench",
                          shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallyfold-bench-"),
                                 "spark.cleaner.referenceTracking.cleanCheckpoints": "true"})
    # warm-up on the smallest tables: JVM code paths, Python workers (not timed)
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        for name in ("q_row_number", "q_fuzzy_cascade"):
            with scratch_run(spark):
                QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        with scratch_run(spark):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    sf_text = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf_text)
    except ValueError:
        sf = sf_text
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
