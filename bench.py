"""Benchmark: run every registered query on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query's full plan is executed with the ``noop`` sink (no driver
transfer), timed separately, after an untimed warm-up of a few queries on
the smallest tables.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import QUERIES  # noqa: E402
from quarry.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]
    spark = local_session(app="quarry-bench", cores=cpus, shuffle_partitions=int(cpus) * 2)
    # Warm-up on the smallest tables (not timed): JVM start, JIT of the
    # regex / JSON / aggregate / join / colour code paths, codegen caches.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in ("q01_word_count", "q05_top_pages_ties", "q07_average_from_json", "q13_temp_range",
                     "q24_spend_by_region", "q27_rgb_to_lab"):
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and not any(o in name for o in only):
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
