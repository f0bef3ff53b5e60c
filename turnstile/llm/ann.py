"""Approximate nearest neighbours by inner product with an inverted multi-index.

Both halves of the vectors are quantised separately; a pair of centroids is a cell.
Codebooks are fitted on a bounded sample, every vector is indexed.  A query walks the
cells in order of summed distance (minus the inner products of its halves with the
centroids) with a heap, until the cells hold enough entries; these are reranked exactly.
The number of centroids grows with the square root of the entries, so that cells stay small, and
how many entries are enough is measured on the sample.

Entries are dealt to blocks of about ``block_rows``: neighbouring cells share a block and a large
cell spans several, so no task holds more than a block, however many equal vectors there
are.  The table of cell sizes (at most ``centroids`` squared rows) is the only thing every
task reads.  A query visits the blocks of its cells and takes its best entries from each;
these few per block are merged.

Defined results: the length of the vectors is the most frequent one among those that are
otherwise fine (the longer one of two that are equally frequent); vectors that are null, of another length, zero, or with null or
non-finite components take no part, as entries or queries; a null vec_id is never a query and
no entry; rows sharing a vec_id are separate entries, except for the query's own id; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .links import whole_groups

#: fitted on at most this many vectors
SAMPLE_ROWS = 20_000
#: entries that a cell of the index holds on average, and the most centroids of a half
CELL_ROWS = 8
MOST_CENTROIDS = 256
ITERATIONS = 12
BLOCK_ROWS = 4096
TOP = 20
#: recall aimed at on the sample when the share of entries to visit is set, and queries for it
RECALL = 0.95
PROBE_QUERIES = 200


def usable(vectors: DataFrame, vec: str, dim: int | None = None) -> DataFrame:
    """vec_id and the vector as doubles, for rows that take part (of any length if ``dim`` is None)."""
    v = F.transform(vec, lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("v", lambda x: x != 0)
    length = F.lit(True) if dim is None else F.size("v") == dim
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & length & fine & some))


def common_length(vectors: DataFrame, vec: str) -> int:
    """The most frequent length among otherwise usable vectors, the longer one of a tie; 0 if there are none."""
    lengths = usable(vectors, vec).groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    return lengths.agg(F.max(F.struct("n", "dim"))["dim"]).first()[0] or 0


def centroids_for(n: int) -> int:
    """Centroids of each half: their pairs hold about ``CELL_ROWS`` entries each."""
    return max(2, min(MOST_CENTROIDS, round(math.sqrt(n / CELL_ROWS))))


def fit_codebook(points: np.ndarray, k: int, iterations: int, seed: int) -> np.ndarray:
    """Lloyd's k-means; empty clusters take the points farthest from their centroids."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    if len(distinct) <= k:
        return distinct
    centres = distinct[rng.choice(len(distinct), k, replace=False)]
    for _ in range(iterations):
        d = (centres ** 2).sum(1) - 2 * points @ centres.T
        near = d.argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, points[:, j], k) for j in range(points.shape[1])], 1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        empty = np.flatnonzero(n == 0)
        if len(empty):
            far = np.argsort(d.min(1) + (points ** 2).sum(1))[::-1][:len(empty)]
            centres[empty] = points[far]
    return centres


def visit_share(points: np.ndarray, books: tuple[np.ndarray, np.ndarray], top: int, recall: float) -> float:
    """The share of entries that must be visited to find ``recall`` of the sample's true neighbours.

    Brute force within the sample, for a few of its vectors; in the whole data neighbours are
    nearer than in a sample of it, so the share errs on the safe side.
    """
    if len(points) <= top:
        return 1.0
    half = points.shape[1] // 2
    halves = points[:, :half], points[:, half:]
    cell = np.zeros(len(points), np.int64)
    for book, part in zip(books, halves):
        cell = cell * len(book) + ((book ** 2).sum(1) - 2 * part @ book.T).argmin(1)
    sizes = np.bincount(cell, minlength=len(books[0]) * len(books[1]))
    needed = []
    for q in range(0, len(points), max(1, len(points) // PROBE_QUERIES)):
        score = points @ points[q]
        score[q] = -np.inf
        near = np.argpartition(-score, top)[:top]
        far = -((books[0] @ halves[0][q])[:, None] + (books[1] @ halves[1][q])[None, :]).ravel()
        order = np.argsort(far, kind="stable")
        reached = np.empty(len(order))
        reached[order] = np.cumsum(sizes[order]) / len(points)
        needed.append(reached[cell[near]])
    return float(np.quantile(np.concatenate(needed), recall))


def fit(vectors: DataFrame, dim: int, centroids: int, sample_rows: int, top: int,
        recall: float) -> tuple[tuple[np.ndarray, np.ndarray], float]:
    """Codebooks of both halves and the share to visit, from the ``sample_rows`` vectors whose ids hash lowest."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").toArrow()
    points = np.array(rows.column("v").combine_chunks().flatten()).reshape(-1, dim) if rows.num_rows else np.zeros((0, dim))
    half = dim // 2
    books = (fit_codebook(points[:, :half], centroids, ITERATIONS, 1),
             fit_codebook(points[:, half:], centroids, ITERATIONS, 2))
    return books, visit_share(points, books, top, recall)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def assign_cells(vectors: DataFrame, books: tuple[np.ndarray, np.ndarray], dim: int) -> DataFrame:
    """Add ``cell`` = (first centroid) * (number of second centroids) + (second centroid)."""
    first, second = books
    half = dim // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column("v"), dim)
            near = [((c ** 2).sum(1) - 2 * part @ c.T).argmin(1) if len(part) else np.zeros(0, int)
                    for c, part in ((first, m[:, :half]), (second, m[:, half:]))]
            yield pa.record_batch([batch.column("vec_id"), batch.column("v"),
                                   pa.array(near[0] * len(second) + near[1], pa.int64())], names=["vec_id", "v", "cell"])
    return vectors.mapInArrow(run, "vec_id long, v array<double>, cell long")


def cells_in_order(near_first: np.ndarray, near_second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells by increasing summed distance, until they hold ``enough`` entries.

    The heap holds the frontier of pairs; a pair enters when both of its predecessors have been taken.
    """
    order_a, order_b = np.argsort(near_first, kind="stable"), np.argsort(near_second, kind="stable")
    a, b = near_first[order_a].tolist(), near_second[order_b].tolist()
    heap, taken, out, held = [(a[0] + b[0], 0, 0)], set(), [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        taken.add((i, j))
        cell = int(order_a[i]) * len(b) + int(order_b[j])
        if sizes[cell]:
            out.append(cell)
            held += int(sizes[cell])
        if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in taken):
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or (i - 1, j + 1) in taken):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
    return out


def block_layout(sizes: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of every cell: cells in a row share a block until it is full."""
    first, count = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    block, held = 0, 0
    for cell, n in enumerate(sizes.tolist()):
        if n > block_rows:
            block += held > 0
            first[cell], count[cell] = block, -(-n // block_rows)
            block, held = block + int(count[cell]), 0
            continue
        if held + n > block_rows:
            block, held = block + 1, 0
        first[cell] = block
        held += n
    return first, count


_SIDE = "block long, kind int, id long, cell long, v array<double>, cells array<long>"


def _deal_entries(dim: int, first: np.ndarray, count: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            ids = batch.column("vec_id").to_numpy()
            spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            n = len(cell)
            yield pa.record_batch([pa.array(first[cell] + spread % count[cell]), pa.array(np.zeros(n, np.int32)),
                                   batch.column("vec_id"), batch.column("cell"), batch.column("v"),
                                   pa.nulls(n, pa.list_(pa.int64()))], names=["block", "kind", "id", "cell", "v", "cells"])
    return run


def _deal_queries(dim: int, books, sizes: np.ndarray, enough: int, first: np.ndarray, count: np.ndarray):
    half = dim // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column("v"), dim)
            near_a, near_b = -(m[:, :half] @ books[0].T), -(m[:, half:] @ books[1].T)
            rows: list[tuple] = []
            for i, q in enumerate(batch.column("vec_id").to_pylist()):
                visits: dict[int, list[int]] = {}
                for cell in cells_in_order(near_a[i], near_b[i], sizes, enough):
                    for block in range(first[cell], first[cell] + count[cell]):
                        visits.setdefault(block, []).append(cell)
                rows += [(block, 1, q, -1, m[i], cells) for block, cells in visits.items()]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64())]
            for lo in range(0, len(rows), 5000):
                cols = zip(*rows[lo:lo + 5000])
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, types)],
                                      names=["block", "kind", "id", "cell", "v", "cells"])
    return run


def best(score: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Positions of the ``top`` largest scores, ties to the smaller id; -inf is left out."""
    valid = np.flatnonzero(score > -np.inf)
    if len(valid) > top:
        edge = np.partition(score[valid], len(valid) - top)[len(valid) - top]
        valid = valid[score[valid] >= edge]
    return valid[np.lexsort((ids[valid], -score[valid]))][:top]


def _search(dim: int, top: int):
    """Rerank the entries of each block for the queries that visit it; rows are sorted by (block, kind)."""
    def reranked(rows: pa.Table, n: int) -> Iterator[pa.RecordBatch]:
        entries, queries = rows.slice(0, n).combine_chunks(), rows.slice(n).combine_chunks()
        if not n or not queries.num_rows:
            return
        ids, cell = entries.column("id").to_numpy(), entries.column("cell").to_numpy()
        m, qm = (_matrix(side.column("v").combine_chunks(), dim) for side in (entries, queries))
        qs, visits = queries.column("id").to_pylist(), queries.column("cells").to_pylist()
        out: list[tuple] = []
        for q0 in range(0, len(qs), 64):
            scores = qm[q0:q0 + 64] @ m.T
            for i, score in enumerate(scores):
                q = qs[q0 + i]
                score[~np.isin(cell, visits[q0 + i]) | (ids == q)] = -np.inf
                # the reported score does not depend on the block's shape
                out += [(q, int(ids[p]), float(np.dot(qm[q0 + i], m[p]))) for p in best(score, ids, top)]
        if out:
            cols = zip(*out)
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))],
                                  names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "block"):
            block, kind = rows.column("block").to_numpy(), rows.column("kind").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]))
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                yield from reranked(rows.slice(lo, hi - lo), int((kind[lo:hi] == 0).sum()))
    return run


def nearest(vectors: DataFrame, queries: DataFrame, dim: int, top: int = TOP, centroids: int | None = None,
            sample_rows: int = SAMPLE_ROWS, recall: float = RECALL, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of each query's ``top`` nearest entries that the index finds.

    ``vectors`` and ``queries`` have vec_id and v (see ``usable``).
    """
    buckets = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    books, share = fit(vectors, dim, centroids or centroids_for(vectors.count()), sample_rows, top, recall)
    if not len(books[0]):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = stored(assign_cells(vectors, books, dim), "multi-index")
    sizes = np.zeros(len(books[0]) * len(books[1]), np.int64)
    for row in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # at most centroids ** 2 rows
        sizes[row["cell"]] = row["n"]
    # the query itself is among the entries
    enough = max(top + 1, int(np.ceil(share * sizes.sum())))
    first, count = block_layout(sizes, block_rows)
    entries = index.mapInArrow(_deal_entries(dim, first, count), _SIDE)
    asked = queries.mapInArrow(_deal_queries(dim, books, sizes, enough, first, count), _SIDE)
    found = (entries.unionByName(asked).repartition(buckets, "block").sortWithinPartitions("block", "kind")
             .mapInArrow(_search(dim, top), "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


def op8_inverted_multi_index(embeddings: DataFrame) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 20; entries are all others' rows."""
    dim = common_length(embeddings, "embedding")
    vectors = usable(embeddings, "embedding", dim)
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), dim)
