"""Embedding whitening by blockwise QR, bidiagonalisation and the qd algorithm.

Entries become integers, x = floor(256 * c), so counts, sums and squared
deviations are exact.  The fit list holds every distinct x-vector once; it is
grouped by Spark, with partial sums, and written.  Tasks centre its rows and
reduce them to one triangular factor R each, block by block; factors are stacked
and reduced again, ``FAN`` at a time, until one is left (tall-skinny QR), so
covariances are never formed and no rows leave their tasks.

The d x d rest runs on the driver: Householder reflections bring R to bidiagonal
form, differential qd with shifts (dqds) finds the squared singular values to
high relative accuracy, and twisted factorisations of the tridiagonal matrix
give the leading vectors.  A shift is a lower bound of the least value (the
inverse of the trace of the inverse, which an unshifted sweep yields), so that
no sweep loses positivity.  Vectors of nearly equal values are made orthogonal.

Cases: rows whose vector is null or holds null or non-finite entries are
dropped; shorter vectors are padded with zeros to the longest; null
ids and repeated rows give their rows; components without variance are left out,
so a fit list of one vector, or an empty table, gives no rows; a deviation
beyond 64 bits is null; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ship_code, written

COMPONENTS = 4
FAN, BLOCK = 32, 2048
_EPS = float(np.finfo(float).eps)


# ----------------------------------------------------------------------------- d x d, on the driver


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, q): diagonals of B and orthogonal q with r = p B q^T, by Householder reflections."""
    m, d = np.array(r, dtype=float), r.shape[1]
    q = np.eye(d)
    for k in range(d):
        v = _reflector(m[k:, k])
        m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        if k < d - 2:
            w = _reflector(m[k, k + 1 :])
            m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ w, w)
            q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ w, w)
    return np.diagonal(m).copy(), np.diagonal(m, 1).copy(), q


def _reflector(x: np.ndarray) -> np.ndarray:
    v = np.array(x)
    v[0] += np.copysign(np.linalg.norm(x), x[0])
    size = np.linalg.norm(v)
    return v / size if size else v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One dqds sweep: new q, new e and the d sequence; None when the shift was too large."""
    d, qs, es, ds = q[0] - shift, [], [], []
    for k in range(len(e)):
        ds.append(d)
        if d < 0:
            return None
        top = d + e[k]
        ratio = q[k + 1] / top if top > 0 else 0.0
        qs.append(top)
        es.append(e[k] * ratio)
        d = d * ratio - shift
    ds.append(d)
    return None if d < 0 else ([*qs, d], es, ds)


def qd_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal matrix (a, b), falling."""
    top = float(max(np.max(a * a, initial=0), np.max(b * b, initial=0)))
    if top == 0:
        return np.zeros(len(a))
    work, out = [([float(x) for x in a * a / top], [float(x) for x in b * b / top], 0.0)], []
    while work:
        q, e, base = work.pop()
        while q:
            small = _EPS * _EPS
            cut = next((k for k in range(len(e)) if e[k] <= small * (base + q[k] + q[k + 1]) or e[k] == 0), None)
            if cut is not None:  # splits; a last value alone is found
                work.append((q[: cut + 1], e[:cut], base))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if len(q) == 1:
                out.append(base + q[0])
                break
            if q[0] < q[-1]:  # graded the other way: the same values with the matrix turned round
                q, e = _turned(q, e)
            plain = _sweep(q, e, 0.0)
            q, e, d = plain
            low = min(d)
            bound = 1 / sum(1 / x for x in d) if low > 0 else 0.0
            shift = bound * (1 - 16 * _EPS * len(q))
            if shift > small * (base + low):
                moved = _sweep(q, e, shift)
                if moved is not None:
                    q, e, base = moved[0], moved[1], base + shift
    return np.sort(np.array(out))[::-1] * top


def _turned(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """qd arrays of the reversed tridiagonal matrix: q from its pivots, e so that the products stay."""
    diag = [q[0], *[x + y for x, y in zip(q[1:], e)]]
    off = [x * y for x, y in zip(q, e)]
    new_q, new_e = [diag[-1]], []
    for k in range(len(off) - 1, -1, -1):
        ratio = off[k] / new_q[-1] if new_q[-1] > 0 else 0.0
        new_e.append(ratio)
        new_q.append(max(diag[k] - ratio, 0.0))
    return new_q, new_e


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of B^T B at ``value``, orthogonal to ``others``.

    Stationary (downward) and progressive (upward) qd transforms of B^T B - value
    meet at a twist; the twist with the least remainder gives the vector.  For
    nearly equal values the next twists give the other vectors of their space.
    """
    d = len(a)
    q, e = a * a, b * b
    tiny = _EPS * _EPS * max(float(q.max()), float(e.max(initial=0)), 1e-300)
    # Downward: B^T B - value = L D L^T, with s the running shift; upward: U D U^T.
    down, low = np.empty(d), np.empty(max(d - 1, 0))
    s = -value
    for k in range(d - 1):
        down[k] = q[k] + s or tiny
        low[k] = a[k] * b[k] / down[k]
        s = e[k] * s / down[k] - value
    down[d - 1] = q[d - 1] + s
    up, high = np.empty(d), np.empty(max(d - 1, 0))
    p = q[d - 1] - value
    for k in range(d - 2, -1, -1):
        up[k + 1] = e[k] + p or tiny
        high[k] = a[k] * b[k] / up[k + 1]
        p = p * q[k] / up[k + 1] - value
    up[0] = p
    # Remainders at each twist: both pivots less the diagonal entry counted twice.
    diag = q - value
    diag[1:] += e
    remainder = np.empty(d)
    for k in range(d):
        left = a[k - 1] * b[k - 1] * low[k - 1] if k else 0.0
        right = a[k] * b[k] * high[k] if k < d - 1 else 0.0
        remainder[k] = diag[k] - left - right
    for twist in np.argsort(np.abs(remainder), kind="stable"):
        z = np.zeros(d)
        z[twist] = 1.0
        for k in range(twist - 1, -1, -1):
            z[k] = -low[k] * z[k + 1]
        for k in range(twist, d - 1):
            z[k + 1] = -high[k] * z[k]
        z /= np.linalg.norm(z)
        left = z
        for _ in range(2):
            for o in others:
                left = left - (o @ left) * o
        if np.linalg.norm(left) > 0.1:
            return left / np.linalg.norm(left)
    raise ArithmeticError("no vector beside those of equal values")


def leading(r: np.ndarray, n: int, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """(unit vectors as columns, variances, trace) of r^T r / n, falling; only components with variance."""
    a, b, q = bidiagonal(r)
    squares = qd_values(a, b)
    trace = float(np.sum(r * r))
    kept = [v for v in squares[:count] if v > (len(a) * _EPS) ** 2 * squares[0] and v > 0]
    vectors: list[np.ndarray] = []
    for v in kept:
        vectors.append(_polished(a, b, v, vectors))
    if not vectors:
        return np.zeros((r.shape[1], 0)), np.zeros(0), trace / n
    u = q @ np.array(vectors).T
    u *= np.sign(u[np.argmax(np.abs(u), axis=0), range(u.shape[1])])
    return u, np.array(kept) / n, trace / n


def _polished(a: np.ndarray, b: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """The twisted vector, orthogonal to those before it also where values differ (which costs no accuracy)."""
    z = twisted_vector(a, b, value, others)
    for o in others:
        z = z - (o @ z) * o
    return z / np.linalg.norm(z)


# ----------------------------------------------------------------------------- rows, in Spark


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the usable rows and the longest vector's length."""
    c = F.col(vec_col)
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf")))
    usable = vectors.filter(c.isNotNull() & ~F.exists(c, bad))
    dim = usable.agg(F.max(F.size(vec_col))).first()[0] or 0
    x = F.transform(c, lambda e: F.floor(e.cast("double") * 256).cast("long"))
    padded = F.when(F.size(vec_col) < dim, F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size(vec_col)))).otherwise(x)
    return usable.select(F.col(id_col).cast("long").alias("vec_id"), padded.alias("x")), dim


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False) if len(column) else np.zeros(0, np.int64)
    return flat.reshape(-1, dim)


def _sums(dim: int):
    def run(batches):
        total, n = [0] * dim, 0
        for batch in batches:
            x = _matrix(batch.column("x"), dim)
            for at in range(0, len(x), BLOCK):
                part = x[at : at + BLOCK]
                exact = part if len(part) and np.abs(part.astype(float)).max() < 2.0**50 else part.astype(object)
                total = [t + int(s) for t, s in zip(total, exact.sum(axis=0))]
                n += len(part)
        yield pa.RecordBatch.from_pydict({"place": list(range(dim)), "total": [str(t) for t in total], "n": [n] * dim},
                                         schema=pa.schema([("place", pa.int32()), ("total", pa.string()), ("n", pa.int64())]))
    return run


def _centred(x: np.ndarray, total: list[int], n: int) -> np.ndarray:
    """x - S/n: whole parts are taken off as integers first."""
    whole = np.array([t // n for t in total], dtype=np.int64)
    rest = np.array([(t % n) / n for t in total])
    return (x - whole).astype(float) - rest


def _factors(dim: int, total: list[int], n: int):
    def run(batches):
        r = np.zeros((0, dim))
        for batch in batches:
            x = _matrix(batch.column("x"), dim)
            for at in range(0, len(x), BLOCK):
                r = np.linalg.qr(np.vstack([r, _centred(x[at : at + BLOCK], total, n)]), mode="r")
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "r": [r.tobytes()]}, schema=_R_SCHEMA)
    return run


_R, _R_SCHEMA = "part int, r binary", pa.schema([("part", pa.int32()), ("r", pa.binary())])


def _stack(dim: int):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("part").to_pylist(), group.column("r").to_pylist()))
        r = np.zeros((0, dim))
        for _, raw in rows:
            r = np.linalg.qr(np.vstack([r, np.frombuffer(raw).reshape(-1, dim)]), mode="r")
        return pa.table({"part": [rows[0][0] // FAN], "r": [r.tobytes()]}, schema=_R_SCHEMA)
    return run


def triangular(fit: DataFrame, dim: int, total: list[int], n: int) -> np.ndarray:
    """R of the centred fit list: one factor a task, stacked FAN at a time."""
    level = written(fit.select("x").mapInArrow(_factors(dim, total, n), _R), "factors")
    top = level.agg(F.max("part")).first()[0] or 0
    while top:
        level = written(level.groupBy((F.col("part") / FAN).cast("int").alias("__group")).applyInArrow(_stack(dim), _R), "factors")
        top //= FAN
    rows = [np.frombuffer(x["r"]).reshape(-1, dim) for x in level.collect()]
    r = rows[0] if rows else np.zeros((0, dim))
    return np.vstack([r, np.zeros((dim - len(r), dim))]) if len(r) < dim else r


@dataclass
class Whitening:
    """What a fit gives: a d-vector of sums, the count, and up to ``COMPONENTS`` vectors with their variances."""
    dim: int
    n: int
    total: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.total, self.n) @ self.vectors / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2."""
        largest = max([abs(t) for t in self.total], default=0) + self.n * (float(np.abs(x.astype(float)).max()) if x.size else 0.0)
        if largest * largest * self.dim < 2.0**62:
            return ((self.n * x - np.array(self.total, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        sums = ((self.n * x.astype(object) - np.array(self.total, dtype=object)) ** 2).sum(axis=1)
        return [int(s) if s < 1 << 63 else None for s in sums]


def fit_list(rows: DataFrame) -> DataFrame:
    """Every distinct x once, written."""
    return written(rows.select("x").distinct(), "fit")


def learn(fit: DataFrame, dim: int, count: int = COMPONENTS) -> Whitening | None:
    """The whitening of a fit list; None without rows."""
    if not dim:
        return None
    sums = fit.mapInArrow(_sums(dim), "place int, total string, n long")
    got = sums.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).orderBy("place").collect()
    n = got[0]["n"] if got else 0
    if not n:
        return None
    total = [int(r["total"]) for r in got]
    vectors, variances, trace = leading(triangular(fit, dim, total, n), n, count)
    return Whitening(dim, n, total, vectors, variances, trace)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened covariance less the identity, over the fit list."""
    k = len(model.variances)

    def moments(batches):
        n, mean, square = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            x = _matrix(batch.column("x"), model.dim)
            for at in range(0, len(x), BLOCK):
                y = model.project(x[at : at + BLOCK])
                m, step = len(y), y.mean(axis=0) - mean
                own = y - y.mean(axis=0)
                square += own.T @ own + np.outer(step, step) * (n * m / (n + m))
                mean = mean + step * (m / (n + m))
                n += m
        yield pa.RecordBatch.from_pydict({"i": [0], "n": [n], "mean": [mean.tolist()], "square": [square.ravel().tolist()]},
                                         schema=pa.schema([("i", pa.int32()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("square", pa.list_(pa.float64()))]))

    parts = fit.select("x").mapInArrow(moments, "i int, n long, mean array<double>, square array<double>")
    # Entry (i, j): sum of the parts' own squares and of n * mean_i * mean_j, less the whole's.
    per = [F.sum(F.col("n") * F.col("mean")[i]).alias(f"m{i}") for i in range(k)]
    both = [F.sum(F.col("square")[i * k + j] + F.col("n") * F.col("mean")[i] * F.col("mean")[j]).alias(f"s{i}_{j}") for i in range(k) for j in range(k)]
    r = parts.agg(F.sum("n").alias("n"), *per, *both).first()
    n = r["n"]
    return max(abs((r[f"s{i}_{j}"] - r[f"m{i}"] * r[f"m{j}"] / n) / n - (i == j)) for i in range(k) for j in range(k))


def _apply(model: Whitening, error: float):
    k = len(model.variances)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), model.dim)
            m = len(x)
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
            deviation = pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)), deviation,
                 pa.array(model.project(x).ravel()), pa.array(np.tile(model.variances / model.trace, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component (columns: ``_OUT``)."""
    spark = vectors.sparkSession
    ship_code(spark)
    rows, dim = quantised(vectors, id_col, vec_col)
    fit = fit_list(rows)
    model = learn(fit, dim, count)
    if model is None or not len(model.variances):
        return spark.createDataFrame([], _OUT)
    return rows.mapInArrow(_apply(model, identity_error(fit, model)), _OUT)
