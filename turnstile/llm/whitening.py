"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers ``x = floor(scale * c)``.  The fit list holds every distinct
vector once.  Its sums are exact; its scatter matrix is summed per task from centred rows,
so only (dimension x dimension) numbers per task are shuffled and one such matrix reaches the
driver.  There a Cholesky factorisation with diagonal pivoting gives ``V = L L'`` and stops at
the numerical rank; one-sided Jacobi rotates the columns of ``L`` until they are orthogonal.
Their squared norms are the eigenvalues of ``V``, the normalised columns its eigenvectors;
``V`` itself is never iterated on.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are
left out, and so are vectors of another length than the most frequent one (ties: the
shorter).  Repeated rows and rows that share or lack a vec_id are returned one by one.
Components without variance are not returned, so a fit list of one vector and an empty table
give no rows.  ``deviation`` is null where it passes 64 bits.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE = 256
COMPONENTS = 4
#: rows multiplied at a time in a task
ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    n: int                    # distinct vectors
    sums: np.ndarray          # long, per dimension
    eigenvalues: np.ndarray   # falling
    components: np.ndarray    # dimension x component, unit columns
    total: float              # trace of the covariance

    def projector(self, k: int) -> np.ndarray:
        """dimension x component: projects a centred vector to unit variance."""
        return self.components[:, :k] / np.sqrt(self.eigenvalues[:k])


def whole_vectors(rows: DataFrame, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, x (array of long) of the rows that take part."""
    def finite(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    found = rows.select(F.col(key), F.col(vector).cast("array<double>").alias("_v"))
    found = found.filter(F.col("_v").isNotNull() & (F.size("_v") > 0) & F.forall("_v", finite))
    x = found.select(key, F.transform("_v", lambda c: F.floor(F.lit(float(scale)) * c).cast("long")).alias("x"))
    length = (x.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("c"))
              .orderBy(F.desc("c"), "d").first())
    return x.filter(F.size("x") == (length["d"] if length else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            yield part, _matrix(part.column("x"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per dimension of what the task read: (dimension, rows, sum)."""
    n, total = 0, None
    for _, x in _blocks(batches):
        n += len(x)
        total = x.sum(axis=0) + (0 if total is None else total)
    if n:
        yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(np.full(len(total), n)),
                               pa.array(total.astype(np.int64))], names=["d", "n", "s"])


def _scatter(mean: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches):
            y = x - mean
            total = y.T @ y + (0 if total is None else total)
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                  names=["i", "j", "v"])
    return run


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """``L`` (dimension x rank) with ``V = L L'``; rows stay in the order of ``V``.

    Each step takes the largest diagonal entry left; it ends where that is rounding noise.
    """
    d = len(v)
    rest, out = v.astype(float).copy(), np.zeros((d, d))
    floor = d * np.finfo(float).eps * max(v.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        p = int(np.argmax(rest.diagonal()))
        pivot = rest[p, p]
        if not pivot > floor:
            return out[:, :k]
        column = rest[:, p] / np.sqrt(pivot)
        out[:, k] = column
        rest -= np.outer(column, column)
        rest[p, :] = rest[:, p] = 0.0
    return out


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Disjoint column pairs per round; over all rounds every pair meets once."""
    seats = list(range(n + n % 2))
    out = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if a < n and b < n]
        out.append((np.array([min(p) for p in pairs], int), np.array([max(p) for p in pairs], int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit columns) of ``factor @ factor.T`` by rotating column pairs of ``factor``."""
    a = factor.copy()
    rounds = _rounds(a.shape[1])
    for _ in range(sweeps):
        worst = 0.0
        for i, j in rounds:
            x, y = a[:, i], a[:, j]
            alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            scale = np.sqrt(alpha * beta)
            off = np.divide(np.abs(gamma), scale, out=np.zeros_like(scale), where=scale > 0)
            worst = max(worst, float(off.max(initial=0.0)))
            turn = off > 1e-16
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros_like(gamma), where=turn)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.sqrt(1 + t * t)
            a[:, i], a[:, j] = c * x - c * t * y, c * t * x + c * y
        if worst < 1e-15:
            break
    e = (a * a).sum(0)
    order = np.argsort(-e, kind="stable")
    order = order[e[order] > 0]
    return e[order], a[:, order] / np.sqrt(e[order])


def fit(vectors: DataFrame) -> Whitening | None:
    """The model of distinct vectors ``x``; None without any."""
    rows = vectors.mapInArrow(_sums, "d int, n long, s long").groupBy("d").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("d").collect()  # one row per dimension
    if not rows:
        return None
    n, sums = rows[0]["n"], np.array([r["s"] for r in rows], np.int64)
    found = vectors.mapInArrow(_scatter(sums / n), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    v = np.zeros((len(sums), len(sums)))
    for r in found.collect():  # one row per pair of dimensions
        v[r["i"], r["j"]] = v[r["j"], r["i"]] = r["v"] / n
    eigenvalues, components = one_sided_jacobi(pivoted_cholesky(v))
    return Whitening(n, sums, eigenvalues, components, float(v.trace()))


def _project(model: Whitening, k: int, deviations: bool):
    w, mean = model.projector(k), model.sums / model.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches):
            z = (x - mean) @ w
            out = [pa.FixedSizeListArray.from_arrays(pa.array(z.ravel()), k).cast(pa.list_(pa.float64()))]
            names = ["z"]
            if deviations:
                rough = ((x * float(model.n) - model.sums) ** 2).sum(1)
                exact = ((x * model.n - model.sums) ** 2).sum(1)  # wraps only where ``rough`` says so
                out = [part.column(0), pa.array(exact, mask=rough > 9.2e18), *out]
                names = [part.schema.names[0], "deviation", *names]
            yield pa.record_batch(out, names=names)
    return run


def project(vectors: DataFrame, model: Whitening, k: int) -> DataFrame:
    """key, deviation, z (array): whitened coordinates of vectors from ``whole_vectors``."""
    key = vectors.schema[0]
    return vectors.mapInArrow(_project(model, k, True), f"`{key.name}` {key.dataType.simpleString()}, deviation long, "
                                                        "z array<double>")


def identity_error(vectors: DataFrame, model: Whitening, k: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    z = vectors.mapInArrow(_project(model, k, False), "z array<double>").select(
        *[F.element_at("z", i + 1).alias(f"z{i}") for i in range(k)])
    mean = z.agg(*[F.avg(f"z{i}").alias(f"z{i}") for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    centred = {i: F.col(f"z{i}") - F.lit(mean[i]) for i in range(k)}
    cov = z.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs))


def op13_cholesky_jacobi_whitening(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component, as the module says."""
    vectors = whole_vectors(embeddings)
    distinct = stored(vectors.select("x").distinct(), "whitening-fit")
    model = fit(distinct)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    k = 0 if model is None else min(components, len(model.eigenvalues))
    if not k:
        return embeddings.sparkSession.createDataFrame([], schema)
    share = F.array(*[F.lit(float(e / model.total)) for e in model.eigenvalues[:k]])
    error = identity_error(distinct, model, k)
    return (project(vectors, model, k).select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
            .select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("at") + 1).alias("component"),
                    F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error")))
