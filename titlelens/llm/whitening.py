"""Whitening of embeddings by a bidiagonal qd solver: blockwise QR of the
centred rows, Householder bidiagonalisation of R, dqds, twisted factorisations."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import cut

EPS = np.finfo(float).eps
#: Rows of one QR step, and triangles that one task of a round joins.
BLOCK, FAN = 4096, 16
_LONG = 2.0 ** 63


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and ``v`` of ``r = u b v'``, by Householder reflections from both sides."""
    a, n = r.astype(float).copy(), r.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.abs(x).max(initial=0.0)
        if size == 0 or not np.abs(x[1:]).any():
            return None
        w = x / size
        w[0] += math.copysign(np.linalg.norm(w), w[0])
        return w / np.linalg.norm(w)

    for k in range(n):
        w = reflector(a[k:, k])
        if w is not None:
            a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        if k < n - 2:
            w = reflector(a[k, k + 1:])
            if w is not None:
                a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
                v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal matrix, descending, by shifted
    differential qd transforms.  No subtraction but that of the shift occurs, so
    small values keep their relative accuracy; a shift that turns an element negative is
    taken back and tried smaller."""
    out: list[float] = []
    tiny = (4 * EPS) ** 2
    parts = [((diagonal * diagonal).tolist(), (above * above).tolist(), 0.0)]
    while parts:
        q, e, moved = parts.pop()
        guess = 0.0
        while q:
            n = len(q)
            if n == 1:
                out.append(moved + q[0])
                break
            if e[-1] <= tiny * (moved + q[-1]) or e[-1] == 0.0:
                out.append(moved + q.pop())
                e.pop()
                guess = 0.0
                continue
            weak = next((k for k in range(n - 2, -1, -1) if e[k] <= tiny * (moved + min(q[k], q[k + 1])) or e[k] == 0.0), None)
            if weak is not None:
                parts.append((q[:weak + 1], e[:weak], moved))
                q, e = q[weak + 1:], e[weak + 1:]
                guess = 0.0
                continue
            if q[0] < 0.25 * q[-1]:  # graded the wrong way round: the small end must come last
                q.reverse()  # read backwards, the array is that of another matrix with the same values
                e.reverse()
            shift = guess
            while True:
                got = _step(q, e, shift)
                if got is not None:
                    break
                shift = 0.0 if shift < 1e-3 * guess else shift / 4
            q, e, least = got
            moved += shift
            # the least d of a transform bounds the smallest value from above, and nears it as e vanishes
            last = q[-1]
            guess = max(0.0, min(least, last * (1 - e[-1] / (e[-1] + last)) if last > 0 else 0.0)) * (1 - 1e-2 if e[-1] > 1e-2 * last else 1 - 1e-9)
    return np.array(sorted(out, reverse=True))


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    d = q[0] - shift
    new_q, new_e, least = [], [], d
    for k in range(len(e)):
        if d < 0:
            return None
        top = d + e[k]
        if top == 0:
            return None
        ratio = q[k + 1] / top
        new_q.append(top)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    return [*new_q, d], new_e, least


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of ``b' b`` to an eigenvalue: the stationary factorisation of
    ``b' b - value`` from the top and the progressive one from the bottom are
    twisted together where they leave the least."""
    n = len(diagonal)
    top = np.abs(diagonal).max(initial=0.0) or 1.0
    a = np.where(np.abs(diagonal) < EPS * EPS * top, EPS * EPS * top, diagonal)  # a zero would end the factorisation
    big, low = a * a, above / a[:-1]
    floor = EPS * EPS * top * top
    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        d = big[i] + s[i]
        d = d if abs(d) > floor else -floor
        down[i] = big[i] * low[i] / d
        s[i + 1] = down[i] * low[i] * s[i] - value
    p[n - 1] = big[n - 1] - value
    for i in range(n - 2, -1, -1):
        d = big[i] * low[i] * low[i] + p[i + 1]
        d = d if abs(d) > floor else -floor
        up[i] = big[i] * low[i] / d
        p[i] = p[i + 1] * (big[i] / d) - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    size = np.abs(z).max()
    z = z / size
    return z / np.linalg.norm(z)


def leading_directions(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest squared singular values of the triangle ``r``, and unit right
    singular vectors as rows; values that rounding alone could make are left out.

    Vectors of values close to each other need not come out orthogonal: those of such a
    cluster are settled by inverse iteration on all of them at once.
    """
    b, c, v = bidiagonalise(r)
    values = dqds(b, c)
    keep = values > (len(b) * EPS) ** 2 * (values[0] if len(values) else 0.0) * 16
    values = values[:k][keep[:k]]
    z = np.array([twisted_vector(b, c, x) for x in values]).reshape(len(values), len(b))
    at = 0
    while at < len(values):
        end = at + 1
        while end < len(values) and values[end - 1] - values[end] < 1e-3 * values[end - 1]:
            end += 1
        if end - at > 1:
            m = np.diag(b * b + np.r_[0.0, c * c]) + np.diag(b[:-1] * c, 1) + np.diag(b[:-1] * c, -1)
            rng = np.random.default_rng(7)
            some = z[at:end].T + 1e-8 * rng.standard_normal((len(b), end - at))
            shifted = m - (values[at:end].mean() * (1 + 4 * EPS)) * np.eye(len(b))
            for _ in range(3):
                some = np.linalg.qr(np.linalg.solve(shifted, np.linalg.qr(some)[0]))[0]
            small = some.T @ m @ some
            _, turn = np.linalg.eigh((small + small.T) / 2)
            z[at:end] = (some @ turn[:, ::-1]).T
        for i in range(at, end):
            z[i] -= z[:at].T @ (z[:at] @ z[i])
            z[i] /= np.linalg.norm(z[i])
        at = end
    u = z @ v.T
    u *= np.where(u[np.arange(len(u)), np.abs(u).argmax(axis=1)] < 0, -1.0, 1.0)[:, None] if len(u) else 1.0
    return values, u


class Whitening(NamedTuple):
    """What ``fit_whitening`` finds: rows of the fit list, sums by dimension, unit directions
    as rows, their variances, the sum of all variances, and the largest error of the identity."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float


def _entries(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are whole (``dims`` entries, all finite), and these as longs ``floor(256 c)``."""
    size = np.asarray(column.value_lengths().fill_null(-1))
    fits = np.flatnonzero(size == dims)
    flat = column.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(fits), dims)
    ok = np.isfinite(flat).all(axis=1)
    with np.errstate(over="ignore"):
        x = np.floor(256 * flat[ok])
    top = x >= _LONG
    x = np.where(top, 0, np.maximum(x, -_LONG)).astype(np.int64)
    x[top] = np.iinfo(np.int64).max
    return fits[ok], x


def _packed(x: np.ndarray) -> list[bytes]:
    """Rows as bytes of the least width that holds the row, which its length tells."""
    most = np.maximum(x.max(axis=1), -(x.min(axis=1) + 1)) if x.size else np.zeros(len(x), np.int64)
    width = np.where(most < 1 << 15, 2, np.where(most < 1 << 31, 4, 8))
    return [row.astype(f"<i{w}").tobytes() for row, w in zip(x, width.tolist(), strict=True)]


def _unpacked(rows: list[bytes], dims: int) -> np.ndarray:
    return np.array([np.frombuffer(r, f"<i{len(r) // dims}").astype(np.int64) for r in rows]).reshape(len(rows), dims)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S / n`` with one rounding where ``n * x`` is exact."""
    if float(np.abs(x).max(initial=0)) * n < 2.0 ** 62 and float(np.abs(sums.astype(float)).max(initial=0)) < 2.0 ** 62:
        return (n * x - sums.astype(np.int64)) / n
    return x - sums.astype(float) / n


def fit_whitening(vectors: DataFrame, column: str = "embedding", components: int = 4) -> Whitening | None:
    """Fits on every distinct vector once; null if there is none.

    1. Distinct vectors of longs are written once, their sums added up as longs.
    2. Every task reduces its centred rows to a triangle, block by block; triangles are
       joined ``FAN`` at a time until one is left, which alone, ``dims`` squared, comes to the driver.
    3. The triangle is bidiagonalised, dqds finds the variances and twisted
       factorisations the directions.
    4. A last pass adds up the covariance of the whitened fit list.
    """
    dims = vectors.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None or dims["d"] == 0:
        return None
    d = dims["d"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(_packed(_entries(batch.column(0), d)[1]), pa.binary())], names=["x"])

    fit = cut(vectors.select(column).mapInArrow(pack, "x binary").distinct(), "fit-list")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            x = _unpacked(batch.column(0).to_pylist(), d)
            n += len(x)
            small = float(np.abs(x).max(initial=0)) * len(x) < 2.0 ** 62
            total += x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0)
        if n:
            yield pa.record_batch([pa.array([n] * d, pa.int64()), pa.array(range(d), pa.int32()), pa.array([str(t) for t in total])], names=["n", "dim", "s"])

    got = fit.mapInArrow(add, "n long, dim int, s string").groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # a row a dimension
    if not got:
        return None
    n, sums = got[0]["n"], [int(r["s"]) for r in sorted(got)]
    s = np.array(sums, object)

    def triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r, held, size = np.zeros((0, d)), [], 0
        for batch in batches:
            held.append(_centred(_unpacked(batch.column(0).to_pylist(), d), n, s))
            size += len(held[-1])
            if size >= BLOCK:
                r, held, size = np.linalg.qr(np.concatenate([r, *held]), mode="r"), [], 0
        if held or len(r):
            yield _triangle(TaskContext.get().partitionId(), np.linalg.qr(np.concatenate([r, *held]), mode="r"))

    def _triangle(at: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([at], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["at", "r"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, r = None, np.zeros((0, d))
        for batch in batches:
            for at, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at // FAN != group:
                    if group is not None:
                        yield _triangle(group, r)
                    group, r = at // FAN, np.zeros((0, d))
                r = np.linalg.qr(np.concatenate([r, np.frombuffer(raw).reshape(-1, d)]), mode="r")
        if group is not None:
            yield _triangle(group, r)

    level = cut(fit.mapInArrow(triangles, "at long, r binary"), "triangles")
    while (most := level.agg(F.max("at")).first()[0]) >= FAN:
        dealt = level.repartition(F.floor(F.col("at") / FAN)).sortWithinPartitions("at")
        level = cut(dealt.mapInArrow(join, "at long, r binary"), "triangles")
    rest = level.orderBy("at").collect()  # at most FAN triangles
    r = np.linalg.qr(np.concatenate([np.frombuffer(bytes(x["r"])).reshape(-1, d) for x in rest]), mode="r")
    r = np.concatenate([r, np.zeros((d - len(r), d))])  # fewer rows than dimensions
    values, directions = leading_directions(r, components)
    variances, trace = values / n, float((r * r).sum()) / n
    scale = directions / np.sqrt(variances)[:, None]
    k = len(variances)

    def covariance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = _centred(_unpacked(batch.column(0).to_pylist(), d), n, s) @ scale.T
            total += np.concatenate((w.T @ w, w.sum(axis=0)[None]))
        yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "v"])

    error = 0.0
    if k:
        sums_ = np.array([x["v"] for x in fit.mapInArrow(covariance, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()]).reshape(k + 1, k)
        mean = sums_[k] / n
        error = float(np.abs(sums_[:k] / n - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(n, sums, directions, variances, trace, error)


def whitened(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", components: int = 4) -> DataFrame:
    """A row for each whole vector and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``; components by falling variance, from 1.

    Vectors that are null, hold null or not finite entries, or are not of the commonest
    length (of ties the shortest) are left out; an id may be null, repeated rows give
    repeated rows.  Entries become longs ``floor(256 c)``, held at the ends of their range.
    Components whose variance rounding alone could make have no row, so equal vectors give none.
    A deviation beyond a long is null.  An empty table gives no row.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [c.split()[0] for c in schema.split(", ")]
    fit = fit_whitening(vectors, column, components)
    if fit is None or not len(fit.variances):
        return vectors.sparkSession.createDataFrame([], schema)
    d, k = len(fit.sums), len(fit.variances)
    s = np.array(fit.sums, object)
    scale = fit.directions / np.sqrt(fit.variances)[:, None]
    explained = fit.variances / fit.trace

    def deviations(x: np.ndarray) -> list[int | None]:
        most = float(np.abs(x).max(initial=0)) * fit.n + float(np.abs(s.astype(float)).max())
        if most < 2.0 ** 62 and most * most * d < 2.0 ** 63:
            gap = fit.n * x - s.astype(np.int64)
            return (gap * gap).sum(axis=1).tolist()
        exact = ((fit.n * x.astype(object) - s) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _entries(batch.column(1), d)
            ids, m = batch.column(0).take(pa.array(at)), len(at)
            of = np.repeat(np.arange(m), k)
            w = _centred(x, fit.n, s) @ scale.T
            yield pa.record_batch([ids.take(pa.array(of)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, fit.n)),
                                   pa.array([v for v in deviations(x) for _ in range(k)], pa.int64()), pa.array(w.ravel()), pa.array(np.tile(explained, m)),
                                   pa.array(np.full(m * k, fit.identity_error))], names=names)

    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(column)).mapInArrow(run, schema)
