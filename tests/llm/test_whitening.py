"""Whitening against an eigen-decomposition, its factorisations, edge cases."""

import numpy as np
import pytest

from turnstile.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int, whitened string, n long"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "w", 1) for i, v in vectors], SCHEMA)


def brute(vectors):
    """{(vec_id, deviation): [whitened rows up to sign]}, explained, n by numpy's solver."""
    good = [(i, np.float32(v)) for i, v in vectors if v and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    d = max({len(v) for _, v in good}, key=lambda k: (sum(len(v) == k for _, v in good), -k))
    good = [(i, v.astype(float)) for i, v in good if len(v) == d]
    x = np.floor(256 * np.array([v for _, v in good])).astype(np.int64)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    y = u - s / n
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    z = (x - s / n) @ q[:, :4] / np.sqrt(e[:4])
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return [i for i, _ in good], deviation, z, e / e.sum(), n


def check(rows, want):
    ids, deviation, z, explained, n = want
    by = {}
    for r in rows:
        by.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    assert len(rows) == 4 * len(ids) and {r["n"] for r in rows} == {n}
    signs = None
    for i, d, zi in zip(ids, deviation, z):
        mine = sorted({(r["component"], r["whitened"], r["explained"], r["identity_error"]) for r in by[(i, d)]})
        assert [m[0] for m in mine] == [1, 2, 3, 4]
        got = np.array([m[1] for m in mine])
        if signs is None and (np.abs(zi) > 1e-3).all():
            signs = np.sign(got * zi)
        if signs is not None:
            assert np.allclose(got, signs * zi, atol=1e-8)
        assert np.allclose([m[2] for m in mine], explained[:4], rtol=1e-9) and mine[0][3] < 1e-9


def test_equals_eigen_decomposition(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 12)) @ np.diag(np.linspace(3, .2, 12))
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    vectors += [(i + 400, vectors[0][1]) for i in range(300)]  # a hot vector counts once
    vectors += [(1, vectors[5][1]), (None, vectors[7][1]), (900, None), (901, []), (902, [1.0] * 11 + [float("nan")]),
                (903, [float("inf")] * 12), (904, [None] + [1.0] * 11), (905, [1.0] * 13), (906, [-0.0] * 12)]
    rows = wh.op13_cholesky_jacobi_whitening(frame(spark, vectors).repartition(5)).collect()
    check(rows, brute(vectors))


def test_matches_numpy_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    check(wh.op13_cholesky_jacobi_whitening(table).collect(), brute(vectors))


def test_low_rank_and_small_tables(spark):
    op = wh.op13_cholesky_jacobi_whitening
    assert op(frame(spark, [])).count() == 0 and op(frame(spark, [(1, None)])).count() == 0
    assert op(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one distinct vector: no variance
    line = op(frame(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(6)])).collect()
    assert len(line) == 6 and {r["component"] for r in line} == {1}
    assert all(abs(r["explained"] - 1) < 1e-12 and r["identity_error"] < 1e-12 for r in line)
    # the deviation passes 64 bits: null, the rest holds
    wide = op(frame(spark, [(1, [1e14, 0.0]), (2, [-1e14, 1.0]), (3, [0.0, 0.0])])).collect()
    assert wide and all(r["deviation"] is None or r["deviation"] >= 0 for r in wide)
    assert any(r["deviation"] is None for r in wide)


@pytest.mark.parametrize("d, rank", [(1, 1), (5, 5), (9, 4), (16, 16)])
def test_factor_and_rotation(d, rank):
    rng = np.random.default_rng(d)
    half = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-4, 5, (1, rank))
    v = half @ half.T
    factor = wh.pivoted_cholesky(v)
    assert factor.shape[1] <= d and np.allclose(factor @ factor.T, v, atol=1e-9 * v.max())
    e, q = wh.one_sided_jacobi(factor)
    assert np.allclose(q.T @ q, np.eye(len(e)), atol=1e-12) and (np.diff(e) <= 0).all()
    assert np.allclose(q * e @ q.T, v, atol=1e-9 * v.max())
    want = np.linalg.eigvalsh(v)[::-1][:len(e)]
    assert np.allclose(e, want, rtol=1e-6, atol=1e-9 * v.max())
