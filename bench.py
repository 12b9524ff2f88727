"""Benchmark the headline queries; prints ONE JSON line on stdout.

Environment:
  BENCH_SF_DIR   input tables (default /root/testdata/sf0.1)
  BENCH_CPUS     local[N] (default 8)
  BENCH_RUNS     timed runs per query after one warm-up (default 5)
  BENCH_QUERIES  comma-separated query names, or "all" (default: headline set)

Each run executes the whole query and writes its result to the ``noop``
sink (every row is produced, nothing is collected to the driver). The value
per query is the median of the timed runs; ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = ["stock_report", "stock_counters", "movie_cells", "upsert_cells", "genre_stats",
            "movie_left_join", "latest_rating_per_user", "mean_turnaround"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    from keystat.queries import QUERIES
    from keystat.session import get_session
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else (wanted.split(",") if wanted else HEADLINE)

    spark = get_session(f"local[{cpus}]", "keystat-bench", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float | None] = {}
    failed: dict[str, str] = {}
    for name in names:
        q = QUERIES[name]
        samples = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                q(spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                if i:  # the first run warms the JVM, file listing and codegen caches
                    samples.append(dt)
            timings[name] = round(statistics.median(samples), 4)
        except Exception as e:  # report the failure, keep measuring the rest
            timings[name] = None
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"bench: {name} failed: {failed[name]}", file=sys.stderr)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(v for v in timings.values() if v is not None), 4)
    out = {"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
           "queries": timings, "sf": sf, "cpus": cpus, "runs": runs}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
