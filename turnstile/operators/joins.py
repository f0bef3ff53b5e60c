"""Joins of a large frame with a side whose size is checked before it is broadcast."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A date dimension has one row per day: a million rows covers 2,700 years.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20
#: a filter of 2**26 bits (8 MB) holds seven million keys at its rate of one false key in a hundred
MAX_BLOOM_BITS = 1 << 26
BLOOM_HASHES = 4


def side_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a frame as rows in memory: every task sends two numbers.

    Fixed-width columns take a word each, text and binary their bytes, nested ones those of their JSON.
    """
    width, rest = 8, []
    for f in df.schema.fields:
        width += 8
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            rest.append(F.octet_length(f.name))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            rest.append(F.octet_length(F.to_json(F.struct(f.name))))
    extra = sum((F.coalesce(c, F.lit(0)) for c in rest), F.lit(0)).cast("long")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(extra), F.lit(0)).alias("b")).first()
    return row["n"], row["n"] * width + row["b"]


def bound_holds(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    rows, size = side_size(df)
    return rows <= max_rows and size <= max_bytes


def _bits_of(on: list[str], bits: int):
    return [F.pmod(F.xxhash64(*on, F.lit(i)), F.lit(bits)) for i in range(BLOOM_HASHES)]


def bloom_words(keys: DataFrame, on: list[str], n_keys: int) -> DataFrame:
    """One row, ``_words``: the bits of a Bloom filter of the keys, 64 to a word.

    Ten bits a key up to ``MAX_BLOOM_BITS``, so the row is bounded; set bits are combined per task before
    they are shuffled.
    """
    bits = min(MAX_BLOOM_BITS, 1 << max(10, math.ceil(math.log2(max(1, n_keys) * 10))))
    at = keys.select(F.explode(F.array(*_bits_of(on, bits))).alias("bit")).select(
        F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 AS INT))").alias("mask"))
    held = at.groupBy("word").agg(F.bit_or("mask").alias("mask"))
    every = keys.sparkSession.range(bits >> 6).withColumnRenamed("id", "word").join(held, "word", "left")
    dense = F.sort_array(F.collect_list(F.struct("word", F.coalesce("mask", F.lit(0)).alias("mask"))))
    return every.agg(F.transform(dense, lambda x: x["mask"]).alias("_words"))


def bloom_reduced(big: DataFrame, keys: DataFrame, on: list[str], n_keys: int) -> DataFrame:
    """The rows of ``big`` whose key may be among ``keys``: all that are, and about one in a hundred of the others.

    The filter's one row meets every row map-side, before anything is shuffled.
    """
    words = bloom_words(keys, on, n_keys).withColumn("_one", F.lit(1))
    met = big.withColumn("_one", F.lit(1)).join(F.broadcast(words), "_one")
    bits = F.size("_words").cast("long") * 64
    hit = None
    for i in range(BLOOM_HASHES):
        bit = F.pmod(F.xxhash64(*on, F.lit(i)), bits)
        word = F.get(F.col("_words"), F.shiftright(bit, 6).cast("int"))
        one = F.expr("1L") == F.call_function("shiftright", word, (bit.bitwiseAND(F.lit(63))).cast("int")).bitwiseAND(F.lit(1))
        hit = one if hit is None else hit & one
    return met.filter(hit).drop("_words", "_one")


def join_bounded(big: DataFrame, small: DataFrame, on, how: str = "inner",
                 max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Join, broadcasting ``small`` only when its rows and bytes are proven within their bounds.

    Within the bounds the large side is joined map-side (no shuffle of it at all).  Beyond them the join is left
    to the planner (sort-merge, AQE skew handling); where rows of ``big`` without a partner are dropped anyway
    (inner and semi joins), a Bloom filter of the small side's keys drops most of them before that shuffle.
    Use it where the large side reaches the join unaggregated.
    """
    rows, size = side_size(small)
    if rows <= max_rows and size <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    if how in ("inner", "left_semi"):
        keys = [on] if isinstance(on, str) else list(on)
        # keys are hashed as they are typed: both sides must agree
        if all(big.schema[k].dataType == small.schema[k].dataType for k in keys):
            big = bloom_reduced(big, small.select(*keys), keys, rows)
            if how == "left_semi":
                # the planner would push a semi join below the filter
                return big.join(small.select(*keys).distinct(), on)
    return big.join(small, on, how)
