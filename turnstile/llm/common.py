"""Helpers shared by the operators: words, stable tables, gapless numbering."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

#: what separates words: space, tab, newline, vertical tab, form feed, return
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: rows that one numbering bucket aims at
BUCKET_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tasks_for(spark: SparkSession, rows: int, per_task: int = BUCKET_ROWS) -> int:
    """How many tasks tables that grow with ``rows`` are worth: one for so many rows, but no fewer than there are cores."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / per_task))


def stored(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, and
    columns that are not reproducible (row ids, sketches) are fixed from here on.
    ``tasks``: as many files at most; more partitions are written several by a task.
    """
    path = scratch_dir(df.sparkSession, name)
    (df if tasks is None else df.coalesce(tasks)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text, unchanged; null text: no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (bound to a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digest_number(*parts: Column) -> Column:
    """A 52-bit number from the MD5 of the parts joined by ':' (the same in any SQL engine)."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def buckets_for(n_rows: int, rows: int = BUCKET_ROWS) -> int:
    return max(1, math.ceil(n_rows / rows))


def order_bucket(key: Column, buckets: int) -> Column:
    """Which of ``buckets`` numbering buckets a row key falls into; null keys go to bucket 0."""
    return F.coalesce(digest_number(F.lit("bucket"), key) % F.lit(buckets), F.lit(0))


def bucket_offsets(counts: DataFrame, group: list[str], bucket: str, amount: str, out: str) -> DataFrame:
    """Where each bucket of a group starts: the amounts of the group's earlier buckets summed.

    ``counts`` has one row per group and bucket, so the window sorts buckets, not rows.
    """
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*group, bucket, F.coalesce(F.sum(amount).over(before), F.lit(0)).cast("long").alias(out))


def gapless(df: DataFrame, group: str, key: str, out: str, buckets: int, ties: list[str] = ()) -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps, ordered by (bucket, key, ties).

    No group is brought together: rows are ranked inside (group, bucket), whose size
    follows ``buckets``, and the buckets' starts come from their counts.  ``group``
    must not be null.
    """
    cut = df.withColumn("_bucket", order_bucket(F.col(key), buckets))
    starts = bucket_offsets(cut.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n")),
                            [group], "_bucket", "_n", "_start")
    inside = Window.partitionBy(group, "_bucket").orderBy(key, *ties)
    return (cut.join(starts, [group, "_bucket"])
            .withColumn(out, F.col("_start") + F.row_number().over(inside).cast("long") - 1)
            .drop("_bucket", "_start"))
