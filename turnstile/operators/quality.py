"""Load verification counts (raw / valid / quarantined / deduplicated / duplicates)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .events import is_valid


def reconcile(parsed: DataFrame) -> DataFrame:
    """One row of load counts from a single aggregate over the parsed messages."""
    valid = is_valid()
    return parsed.agg(
        F.count(F.lit(1)).alias("raw_records"),
        F.count_if(valid).alias("valid_records"),
        F.count_if(~valid).alias("quarantined_records"),
        F.count_distinct(F.when(valid, F.col("id"))).alias("deduplicated_records"),
    ).withColumn("duplicate_records", F.col("valid_records") - F.col("deduplicated_records"))


def observed(df: DataFrame, name: str, **exprs) -> tuple[DataFrame, Observation]:
    """Attach named metrics computed during whatever action runs ``df`` (no extra pass)."""
    obs = Observation(name)
    metrics = [e.alias(k) for k, e in exprs.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *metrics), obs
