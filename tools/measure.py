"""Per-query timings plus shuffle/input bytes from Spark's event log.

    python tools/measure.py [sf_dir] [runs] > table.md

The event log goes to a fresh scratch folder (no UI, no server).  Jobs are
attributed to a query by submission time (threads started by a query carry
no job description), task metrics are summed per query and divided by the
number of runs.  Prints a Markdown table.
"""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from turnstile import queries as registry  # noqa: E402
from turnstile.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    runs = int(argv[2]) if len(argv) > 2 else 3
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    cpus = 8
    spark = build_session(f"local[{cpus}]", app="turnstile-measure", shuffle_partitions=2 * cpus,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false",
                                 "spark.driver.memory": "16g"})
    windows, secs, rows = [], {}, {}
    registry.QUERIES["mart_entity_totals"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name, fn in registry.QUERIES.items():
        times = []
        for _ in range(runs):
            registry._STORES.clear()
            registry._MSG_FILES.clear()
            start = time.time() * 1000
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
            windows.append((start, time.time() * 1000, name))
            time.sleep(0.05)
        secs[name] = statistics.median(times)
        rows[name] = df.count()
    spark.stop()

    job_stages, job_query = {}, {}
    stage_bytes: dict[int, list[int]] = {}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p) and "appstatus" not in os.path.basename(p)]
    for path in paths:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    sub = ev.get("Submission Time", 0)
                    q = next((n for s, e, n in windows if s <= sub <= e), None)
                    if q:
                        for sid in ev.get("Stage IDs", []):
                            job_query[sid] = q
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    sw = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    ib = (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                    acc = stage_bytes.setdefault(ev["Stage ID"], [0, 0])
                    acc[0] += sw
                    acc[1] += ib
    shuffle, inp = {}, {}
    for sid, (sw, ib) in stage_bytes.items():
        q = job_query.get(sid)
        if q:
            shuffle[q] = shuffle.get(q, 0) + sw
            inp[q] = inp.get(q, 0) + ib
    today = dt.date.today().isoformat()
    conf = f"local[{cpus}], AQE on, shuffle.partitions {2 * cpus}"
    print("| query | median seconds | rows out | shuffle bytes | input bytes | Spark config | date |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name in registry.QUERIES:
        print(f"| {name} | {secs[name]:.2f} | {rows[name]} | {shuffle.get(name, 0) // runs:,} | "
              f"{inp.get(name, 0) // runs:,} | {conf} | {today} |")
    print(f"\nevent log: {log_dir}", file=sys.stderr)


if __name__ == "__main__":
    main(sys.argv)
