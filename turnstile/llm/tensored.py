"""Near duplicates by MinHash with tensored banding.

A table key of ``2 * k`` minhashes is a pair of two smaller keys of ``k``.  Two collections of ``m`` small
keys are computed; every pair of one from each is a table, so ``m * m`` tables need ``2 * m * k`` minhashes
where independent tables would need ``2 * k * m * m``.  Sets of similarity ``t`` share a table unless all
small keys of a collection differ: the misses are at most ``2 * (1 - t**k)**m``, from which ``m`` follows.
``k`` grows with the logarithm of the number of documents, so that unlike texts rarely meet.

Sets that share a table are candidates.  They are verified on their full sets by ``links``, which
attaches members to pivots instead of comparing all pairs of a table.

Defined results: A-Z count as a-z; a text of one word is one shingle; texts without words and null texts
have none and are linked with nothing, and neither are rows without doc_id (component_id null,
kept).  Every row is linked by its own text, also where doc_ids repeat; rows that share the smallest
doc_id of a component are all kept.  Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import connected_components
from .links import (SMALL, attach, bin_sketches, connect, set_ids, shared_entries, shingle_sets, starts_of,
                    text_fetcher)
from .wordhash import SECOND_BASE, U, hashed_texts, mixed, slices

SHINGLE = 2
#: linked at NUM / DEN of similarity
NUM, DEN = 80, 100
#: share of pairs at the threshold that meet in a table, at least
RECALL = 0.999
#: similarity of unlike texts, which meet about once per table
CHANCE = 0.04

#: marks: the small keys, first those of the left collection
_SIGNATURE = "doc_id long, text_hash long, set_a long, set_b long, n long, sketch binary, marks array<long>"


def banding(n_docs: int, threshold: float, recall: float = RECALL, chance: float = CHANCE) -> tuple[int, int]:
    """(k, m): minhashes per small key, small keys per collection."""
    k = max(1, math.ceil(math.log(max(n_docs, 2)) / (-2 * math.log(chance))))
    return k, max(1, math.ceil(math.log(1 - math.sqrt(recall)) / math.log(1 - threshold ** k)))


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(*hashed_texts(column, lower=True), SHINGLE)


def small_keys(token: np.ndarray, at: np.ndarray, k: int, m: int) -> np.ndarray:
    """(2 * m) x texts: the small keys, first those of the left collection; 0 for empty sets."""
    out = np.zeros((2 * m, len(at) - 1), U)
    held = np.flatnonzero(np.diff(at))
    if len(held):
        seeds = mixed(np.arange(1, 2 * m * k + 1).astype(U) * SECOND_BASE)
        for i, seed in enumerate(seeds):
            # tokens are spread hashes already: an odd factor orders them anew
            least = np.minimum.reduceat((token ^ seed) * (seed | U(1)), at[held])
            out[i // k, held] = mixed(out[i // k, held] + least)
    return out


def _signatures(k: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = part.num_rows
                token, text = shingles(part.column("text"))
                at = starts_of(text, rows)
                set_a, set_b = set_ids(token, at)
                keys = small_keys(token, at, k, m).view(np.int64)
                marks = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * 2 * m), pa.array(keys.T.ravel()))
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(set_a), pa.array(set_b),
                     pa.array(np.diff(at).astype(np.int64)),
                     pa.array([row.tobytes() for row in bin_sketches(token, text, rows)], pa.binary()), marks],
                    names=["doc_id", "text_hash", "set_a", "set_b", "n", "sketch", "marks"])
    return run


def first_table(m: int):
    """``meeting`` for ``connect``: the first table (from 1) whose small keys, left and right, both sets share."""
    def meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        equal = (a == b) & (a != 0)
        left, right = equal[:, :m], equal[:, m:]
        both = left.any(axis=1) & right.any(axis=1)
        return np.where(both, left.argmax(axis=1) * m + right.argmax(axis=1) + 1, 0)
    return meeting


def shared_tables(m: int):
    """``buckets`` for ``connect``: the tables of the sets whose left small key another set has; others meet nobody there."""
    def buckets(held: DataFrame, tasks: int) -> DataFrame:
        keys = held.select("rep", "own", F.slice("marks", m + 1, m).alias("right"), F.posexplode(F.slice("marks", 1, m)).alias("i", "left"))
        met = stored(shared_entries(keys, "left", "left-keys", tasks), "left-met", tasks)
        return (met.select("rep", "own", "i", "left", F.posexplode("right").alias("j", "right"))
                .select("rep", "own", F.xxhash64("left", "right").alias("bucket"), (F.col("i") * m + F.col("j") + 1).cast("long").alias("place")))
    return buckets


def near_duplicates(docs: DataFrame, recall: float = RECALL, small: int = SMALL) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    k, m = banding(docs.count(), NUM / DEN, recall)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    rows = stored(texts.mapInArrow(_signatures(k, m), _SIGNATURE), "signatures")
    first = F.min_by(F.struct("doc_id", "text_hash", F.col("n").cast("int").alias("n"), "sketch", "marks"), "doc_id")
    classes = stored(rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b").agg(first.alias("c"))
                     .select(F.col("set_a").alias("rep"), "c.*"), "classes")
    reps = classes.select("rep", "n", "sketch", "marks")
    left, right = F.slice("marks", 1, m), F.slice("marks", m + 1, m)
    some = F.zip_with(left, right, lambda x, y: F.xxhash64(x, y))
    fetch = text_fetcher(texts, classes, shingles)
    star, hung = attach(reps, some, fetch, NUM, DEN)
    links = connect(reps, shared_tables(m), star, hung, fetch, first_table(m), NUM, DEN, small)
    groups = connected_components(stored(links, "links"), "a", "b")
    members = (classes.select("rep", "doc_id").join(groups, F.col("rep") == F.col("node"), "left")
               .select("rep", "doc_id", F.coalesce("component", "rep").alias("group")))
    smallest = members.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    named = members.join(smallest, "group").select(F.col("rep").alias("set_a"), "component_id")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("set_a")).alias("set_a")
    found = rows.select("doc_id", F.col("n").alias("n_shingles"), own).join(named, "set_a", "left")
    return (found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def op12_tensored_minhash(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
