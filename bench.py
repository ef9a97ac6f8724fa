"""Bench: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS] with the
``noop`` sink and print one JSON line.

Each query is run once as a warm-up (unless BENCH_WARMUP=0) and then timed
BENCH_REPEATS times (default 3); a query's time is the median of its timed runs and the
value is the sum of those medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from palimpsest.plans.registry import all_queries  # noqa: E402
from palimpsest.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm = os.environ.get("BENCH_WARMUP", "1") != "0"
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, app="palimpsest-bench")
    times: dict[str, float] = {}
    for name, (fn, _sql) in all_queries().items():
        if only and name not in only:
            continue
        if warm:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(max(1, int(os.environ.get("BENCH_REPEATS", "3")))):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
