"""Top-n previews (O3, K8, V7).  A limit here is the feature: an ordered report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows by ``order`` (planned as TakeOrderedAndProject: each task keeps
    its own n best, the driver merges n x tasks rows, never the whole input)."""
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    return df.orderBy(*cols).limit(n)


def preview(df: DataFrame, n: int, key: str) -> DataFrame:
    """Deterministic first ``n`` rows by a key (instead of an unordered ``show``)."""
    return top_n(df, n, F.asc_nulls_first(key))
