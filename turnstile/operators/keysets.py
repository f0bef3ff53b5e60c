"""Key-set operators: distinct keys, set difference, semi/anti filters, replace-by-key.

All of these stay distributed: a key set is a DataFrame, never a driver list.
Semi and anti joins against a small key set are turned into broadcast joins
by AQE from the measured size; large key sets stay shuffle joins.  Unlike
``~isin(list)``, an anti join keeps rows whose key is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def only_keys_in(rows: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Rows whose key appears in ``keys`` (IN-list / EXISTS)."""
    return rows.join(keys.select(*on), list(on), "left_semi")


def drop_keys_in(rows: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Rows whose key does not appear in ``keys`` (NOT IN / NOT EXISTS); null keys kept."""
    return rows.join(keys.select(*on), list(on), "left_anti")


def key_difference(incoming: DataFrame, done: DataFrame, *on: str) -> DataFrame:
    """Distinct incoming keys minus keys already done."""
    return drop_keys_in(distinct_keys(incoming, *on), done, *on)


def replace_by_key(old: DataFrame, new: DataFrame, *on: str) -> DataFrame:
    """``new`` plus the rows of ``old`` whose key ``new`` does not carry."""
    return drop_keys_in(old, new, *on).unionByName(new.select(*old.columns))


def latest_version(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Replace-by-key over a versioned log: per key, the rows of its newest version.

    Aggregate-based (max version per key, then a semi join on (key, version)),
    so a hot key is reduced map-side instead of being sorted in one task.
    """
    newest = rows.groupBy(*keys).agg(F.max(version).alias(version))
    # null keys never match in a join; null-safe equality keeps them
    cond = [rows[k].eqNullSafe(newest[k]) for k in keys] + [rows[version] == newest[version]]
    return rows.join(newest, cond, "left_semi")
