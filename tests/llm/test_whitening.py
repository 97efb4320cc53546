"""Whitening against dense eigenvectors, and the solver's parts on their own."""

import math

import numpy as np
import pytest

from titlelens.llm.whitening import bidiagonalise, dqds, fit_whitening, leading_directions, twisted_vector, whitened

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, d, components=4):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, s = len(fit), [sum(int(x[k]) for x in {tuple(x) for _, x in kept}) for k in range(d)]
    a = fit - fit.mean(axis=0)
    _, e, u = np.linalg.svd(a, full_matrices=False)
    trace = (e * e).sum() / n
    e, u = (e * e / n)[:components], u[:components].T
    out = {}
    for i, x in kept:
        dev = sum((n * int(c) - t) ** 2 for c, t in zip(x, s))
        w = (np.array(x) - np.array(s) / n) @ u / np.sqrt(e)
        out.setdefault(i, []).append((n, dev, w))
    return out, e / trace


def check(spark, rows, d):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "1 as component", "2 as x", "'z' as n").repartition(3)
    want, explained = plain([(r.vec_id, r.embedding) for r in df.collect()], d)
    got = {}
    for r in whitened(df).collect():
        got.setdefault((r.vec_id, r.component), []).append(r)
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    assert len(got) == 4 * len(want)
    signs = {}
    for i, each in want.items():
        for c in range(4):
            rs = sorted(got[i, c + 1], key=lambda r: (r.deviation, abs(r.whitened)))
            assert len(rs) == len(each)
            for r, (n, dev, w) in zip(rs, sorted(each, key=lambda x: (x[1], abs(x[2][c]))), strict=True):
                assert (r.n, r.deviation) == (n, dev)
                if abs(w[c]) > 1e-6:
                    assert signs.setdefault(c, np.sign(r.whitened * w[c])) == np.sign(r.whitened * w[c])
                assert abs(abs(r.whitened) - abs(w[c])) < 1e-8


def vectors(d=12, n=400, seed=3):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((n, d)) * np.exp(np.linspace(2, -1, d)) @ np.linalg.qr(rng.standard_normal((d, d)))[0]
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(a)]


def test_against_dense_solver(spark):
    rows = vectors()
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # one vector holds much of the table
    rows += [(2000, None), (2001, [None] * 12), (2002, [float("nan")] + [0.0] * 11), (2003, [float("inf")] + [0.0] * 11), (2004, []), (2005, [1.0] * 11),
             (None, rows[3][1]), (5, rows[9][1]), (5, rows[9][1]), (2006, [-0.0] * 12)]
    check(spark, rows, 12)


def test_large_entries(spark):
    """Widths of two, four and eight bytes, and deviations that only whole numbers give."""
    rows = vectors(5, 60)
    check(spark, rows + [(500, [5e4, 1.0, 0.5, 2.0, -1e5])], 5)
    out = whitened(spark.createDataFrame([(i, v, 0) for i, v in [*rows, (900, [1e30, 0.0, 0.0, 0.0, 0.0])]], SCHEMA)).collect()
    assert {r.deviation for r in out if r.vec_id == 900} == {None} and len(out) == 61 * len({r.component for r in out})


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_fit(spark, rows):
    assert whitened(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).count() == 0


def test_rank_below_four(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0, 0.0, 1.0]) for i in range(50)]
    out = whitened(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    assert {r.component for r in out} == {1} and all(abs(r.explained - 1) < 1e-12 for r in out)


def test_blocks_and_rounds_of_triangles(spark, monkeypatch):
    import titlelens.llm.whitening as w

    monkeypatch.setattr(w, "BLOCK", 20)
    monkeypatch.setattr(w, "FAN", 2)
    rows = vectors()
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    few = fit_whitening(df)
    monkeypatch.undo()
    assert np.allclose(few.variances, fit_whitening(df).variances, rtol=1e-12) and few.n == 400


@pytest.mark.parametrize("n", [1, 2, 3, 8, 40, 150])
def test_solver_parts(n):
    rng = np.random.default_rng(n)
    r = np.linalg.qr(rng.standard_normal((3 * n, n)) * np.exp(rng.uniform(-9, 3, n)), mode="r")
    b, c, v = bidiagonalise(r)
    full = np.diag(b) + np.diag(c, 1)
    assert np.allclose(v.T @ v, np.eye(n)) and np.allclose(full.T @ full, v.T @ r.T @ r @ v, atol=1e-12 * np.abs(r).max() ** 2)
    values = dqds(b, c)
    assert np.allclose(values, np.linalg.svd(full, compute_uv=False) ** 2, rtol=1e-9)
    z = twisted_vector(b, c, values[0])
    assert np.abs(full.T @ (full @ z) - values[0] * z).max() < 1e-12 * values[0] * n


def test_small_values_keep_relative_accuracy():
    """Products of a graded bidiagonal matrix are exact for dqds, not for a dense solver."""
    b, c = 10.0 ** -np.arange(0, 24, 2.0), 10.0 ** -np.arange(1, 23, 2.0)
    values = dqds(b, c)
    assert abs(np.prod(np.sqrt(values)) / np.prod(b) - 1) < 1e-12 and values[-1] < 1e-40


@pytest.mark.parametrize("r", [np.eye(6), np.diag([3.0, 3, 3, 1, 0, 0]), np.diag([1.0, 2, 2 + 1e-13, 2, 1, 5]), np.zeros((5, 5)), np.triu(np.ones((7, 7)))])
def test_equal_and_missing_values(r):
    values, u = leading_directions(r, 4)
    assert np.allclose(u @ u.T, np.eye(len(u)), atol=1e-13)
    assert np.allclose(r.T @ r @ u.T, u.T * values, atol=1e-12)
    assert len(values) == min(4, np.linalg.matrix_rank(r))
