"""Whitening against numpy's eigenvectors and the contract's exact integers."""

import math

import numpy as np
import pytest

from contrail.llm import whitening as wh
from contrail.llm.queries import op13_whitening


def factor(x):
    r = np.linalg.qr(x - x.mean(axis=0), mode="r")
    return np.vstack([r, np.zeros((x.shape[1] - len(r), x.shape[1]))])


@pytest.mark.parametrize("seed", range(12))
def test_values_and_vectors(seed):
    g = np.random.default_rng(seed)
    d, n = int(g.integers(1, 60)), int(g.integers(60, 300))
    x = g.normal(size=(n, d)) * np.exp(g.normal(size=d) * g.choice([0, 1, 4]))
    if seed % 3 == 0 and d > 3:
        x[:, 1], x[:, 2] = x[:, 0], 0
    r = factor(x)
    squares = wh.qd_values(*wh.bidiagonal(r)[:2])
    want = np.linalg.svd(r, compute_uv=False) ** 2
    assert np.abs(squares - want).max() < 1e-13 * want[0]
    u, e, trace = wh.leading(r, n)
    cov = np.cov(x, rowvar=False, bias=True).reshape(d, d)
    assert np.abs(cov @ u - u * e).max() < 1e-12 * e[0]
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13
    assert math.isclose(trace, np.trace(cov), rel_tol=1e-12)


@pytest.mark.parametrize("r", [np.eye(6), np.diag([3.0, 3, 3, 2, 2, 1]), np.diag([1.0, 1e-9, 1e-9, 0]), np.zeros((3, 3))])
def test_equal_and_zero_values(r):
    u, e, _ = wh.leading(r, 1)
    assert np.abs(r.T @ r @ u - u * e).max(initial=0) < 1e-13
    assert np.abs(u.T @ u - np.eye(len(e))).max(initial=0) < 1e-13
    assert len(e) == min(4, np.linalg.matrix_rank(r)) or r[0, 0] == 1.0


def test_small_values_keep_their_digits():
    """dqds keeps relative accuracy where an eigenvalue routine on the covariance would not."""
    a, b = np.array([1.0, 1e-6, 1e-12]), np.array([1e-3, 1e-9])
    from fractions import Fraction as Q

    got = wh.qd_values(a, b)
    # det(B^T B) = (a1 a2 a3)^2 exactly, so the product of the values is known.
    assert math.isclose(math.prod(got), float(Q(a[0]) ** 2 * Q(a[1]) ** 2 * Q(a[2]) ** 2), rel_tol=1e-12)


def run(spark, tmp_path, rows, kind="array<float>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int")
    for c in ("x", "n", "part", "r", "total", "place"):
        df = df.selectExpr("*", f"'y' as `{c}`")
    df.repartition(5).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    return op13_whitening(spark, str(tmp_path)).collect()


def plain(vectors):
    """(x, n, S, V, e, u) of the contract, by numpy."""
    x = [tuple(int(math.floor(256 * float(np.float32(c)))) for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), dtype=float)
    s = [sum(c) for c in zip(*sorted(set(x)))]
    cov = np.cov(fit, rowvar=False, bias=True)
    e, u = np.linalg.eigh(cov)
    return x, len(fit), s, cov, e[::-1], u[:, ::-1]


def test_query_matches_numpy(spark, tmp_path):
    g = np.random.default_rng(5)
    vectors = (g.normal(size=(700, 12)) * np.linspace(3, 0.5, 12)).astype(np.float32).tolist()
    vectors += [vectors[0]] * 300  # one vector holds a third of all rows
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    bad = [(5000, None, 0), (5001, [1.0] * 11 + [None], 0), (5002, [float("nan")] + [0.0] * 11, 0), (5003, [float("inf")] * 12, 0), (5004, [-float("inf")] * 12, 0)]
    got = run(spark, tmp_path, rows + bad + [(None, vectors[3], 1)])
    x, n, s, cov, e, u = plain(vectors)
    assert len(got) == 4 * (len(rows) + 1)
    signs = {}
    for r in got:
        i = 3 if r.vec_id is None else r.vec_id
        k = r.component - 1
        assert r.n == n and r.deviation == sum((n * a - b) ** 2 for a, b in zip(x[i], s))
        want = (np.array(x[i]) - np.array(s) / n) @ u[:, k] / math.sqrt(e[k])
        sign = signs.setdefault(k, 1 if r.whitened * want > 0 else -1)
        assert abs(r.whitened - sign * want) < 1e-9
        assert math.isclose(r.explained, e[k] / np.trace(cov), rel_tol=1e-9) and r.identity_error < 1e-10


def test_edge_cases(spark, tmp_path):
    assert run(spark, tmp_path, []) == []
    assert run(spark, tmp_path, [(1, None, 0)]) == []
    assert run(spark, tmp_path, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]) == []  # one distinct vector: no variance
    assert run(spark, tmp_path, [(1, [], 0)]) == []
    two = run(spark, tmp_path, [(1, [1.0, 2.0], 0), (2, [3.0, 2.0], 0), (2, [3.0, 2.0], 0)])
    assert sorted((r.vec_id, r.component, r.n, round(abs(r.whitened), 9)) for r in two) == [(1, 1, 2, 1.0), (2, 1, 2, 1.0), (2, 1, 2, 1.0)]
    padded = run(spark, tmp_path, [(1, [1.0], 0), (2, [1.0, 0.0], 0), (3, [0.0, 1.0], 0)])
    assert {r.n for r in padded} == {2} and len(padded) == 3


def test_deviations_beyond_64_bits(spark, tmp_path):
    huge = run(spark, tmp_path, [(1, [1e15, 0.0], 0), (2, [-1e15, 1.0], 0), (3, [0.0, 0.0], 0)], "array<double>")
    assert {r.deviation for r in huge if r.vec_id == 1} == {None}


def test_block_and_fan_do_not_matter(spark, tmp_path, monkeypatch):
    g = np.random.default_rng(8)
    rows = [(i, v, 0) for i, v in enumerate(g.normal(size=(300, 6)).astype(np.float32).tolist())]
    one = {(r.vec_id, r.component): r.whitened for r in run(spark, tmp_path / "a", rows)}
    monkeypatch.setattr(wh, "BLOCK", 7)
    monkeypatch.setattr(wh, "FAN", 2)
    two = {(r.vec_id, r.component): r.whitened for r in run(spark, tmp_path / "b", rows)}
    assert all(abs(one[k] - two[k]) < 1e-10 for k in one)
