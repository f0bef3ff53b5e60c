"""Deduplication by key: keep the latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .events import latest_by


def latest_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Latest row per ``keys`` by descending ``order``; a skew-safe aggregate (see latest_by)."""
    return latest_by(df, keys, order).select(*df.columns)
