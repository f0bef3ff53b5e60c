"""Batch sinks shared by the plans: partitioned Parquet, versioned overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_partitioned(df: DataFrame, path: str, keys: list[str], mode: str = "overwrite",
                      dynamic: bool = False, max_records_per_file: int = 5_000_000) -> None:
    """Parquet partitioned by ``keys`` (K2).

    Rows are first rebalanced on the partition keys so each task writes few
    partition folders (no small-file explosion); AQE splits a partition value
    that holds a disproportionate share of rows across several tasks instead
    of sending it whole to one.
    """
    writer = (df.hint("rebalance", *keys).write.mode(mode)
              .option("maxRecordsPerFile", max_records_per_file)
              .partitionBy(*keys))
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
