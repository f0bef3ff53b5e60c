"""Bounded load of a message backlog: parse, quarantine, dedup, partitioned write.

The source is read once: parsed messages go to the shared scratch folder, and
the table, the quarantine and the counts come from there, so they agree even
when the topic grows meanwhile.  Quarantined messages are written with a reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators.quality import observed
from ..session import scratch_dir
from ..sinks import write_partitioned

PARTITION_KEYS = ["lineName", "arrival_date"]


@dataclass
class BacklogCounts:
    raw: int
    valid: int
    quarantined: int
    deduplicated: int

    @property
    def duplicates(self) -> int:
        return self.valid - self.deduplicated


def load_backlog(raw: DataFrame, out: str, quarantine_out: str,
                 keys: list[str] = PARTITION_KEYS) -> BacklogCounts:
    parsed, seen = observed(ev.parse_arrivals(raw), "arrivals_parsed",
                            raw=F.count(F.lit(1)), valid=F.count_if(ev.is_valid()))
    staged = scratch_dir(raw.sparkSession, "backlog")
    parsed.write.parquet(staged)
    parsed = raw.sparkSession.read.schema(parsed.schema).parquet(staged)
    deduped = ev.dedup_arrivals(ev.valid_rows(parsed)).withColumn("loaded_at", F.current_timestamp())
    deduped, kept = observed(deduped, "arrivals_kept", deduplicated=F.count(F.lit(1)))
    write_partitioned(deduped, out, keys)
    ev.quarantine_rows(parsed).write.mode("overwrite").parquet(quarantine_out)
    a, b = seen.get, kept.get
    return BacklogCounts(raw=a["raw"], valid=a["valid"], quarantined=a["raw"] - a["valid"],
                         deduplicated=b["deduplicated"])


def per_key_counts(df: DataFrame, key: str, order_by_count: bool = True) -> DataFrame:
    """Record count per line (DESC) or per date (ASC) (V2, V3)."""
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("record_count"))
    if order_by_count:
        return out.orderBy(F.desc("record_count"), F.asc_nulls_first(key))
    return out.orderBy(F.asc_nulls_first(key))
