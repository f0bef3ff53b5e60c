"""Benchmark every registered query at one scale factor; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query's result is fully computed with the ``noop`` sink (no driver
collect).  Queries that load a store or stream a topic include that work;
their per-process caches are cleared before every run.  The queries of the arrival feed read a
topic, which is written before their time starts; ``with_building`` gives their time with it.
Every query runs ``BENCH_RUNS`` times (default 2) after a warm-up, and the best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from turnstile import queries as registry  # noqa: E402
from turnstile.session import build_session  # noqa: E402


def run(spark, sf_dir: str, name: str) -> tuple[float, float]:
    """Seconds of the query, and with the writing of the topic that it reads."""
    for cache in (registry._STORES, registry._MSG_FILES, registry._UNDATED, registry._KEYED):
        cache.clear()
    start = t0 = time.perf_counter()
    if name in registry.FEED:
        registry._message_files(spark, sf_dir)
        t0 = time.perf_counter()
    registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    end = time.perf_counter()
    return end - t0, end - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", app="turnstile-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    names = [n for n in registry.QUERIES if not only or n in only]

    # warm-up: JIT-compile the common operators and fill file-listing caches
    for name in ("mart_row_counts", "dedup_events_by_id", "keyed_latest"):
        if name in registry.QUERIES:
            run(spark, sf_dir, name)
    timings, building = {}, {}
    for name in names:
        taken = [run(spark, sf_dir, name) for _ in range(max(1, runs))]
        timings[name] = round(min(t for t, _ in taken), 3)
        if name in registry.FEED:
            building[name] = round(min(t for _, t in taken), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum_of_best_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "with_building": building,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
