"""Natural splines over blocks against a dense solve of the whole system."""

import random

import numpy as np
import pytest

from ledgerlake.operators import spline as sp


def dense_spline(x, y, at):
    n = len(x)
    if n < 2:
        return [None] * len(at)
    h = np.diff(x)
    a, d = np.eye(n), np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1:i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        d[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
    m = np.linalg.solve(a, d)
    out = []
    for t in at:
        k = np.searchsorted(x, t) - 1
        if not 0 <= k < n - 1:
            out.append(None)
            continue
        u, v = (x[k + 1] - t) / h[k], (t - x[k]) / h[k]
        out.append(u * y[k] + v * y[k + 1] + ((u ** 3 - u) * m[k] + (v ** 3 - v) * m[k + 1]) * h[k] ** 2 / 6)
    return out


def test_tridiagonal_against_dense():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 7, 8, 33, 100):
        a, c = rng.uniform(0.1, 1, n), rng.uniform(0.1, 1, n)
        b = 2 * (a + c)
        d = rng.normal(size=(n, 3))
        full = np.diag(b) + np.diag(a[1:], -1) + np.diag(c[:-1], 1)
        assert np.allclose(sp.tridiagonal(a, b, c, d), np.linalg.solve(full, d), atol=1e-12)


@pytest.mark.parametrize("block_rows,block_knots", [(7, 5), (50, 1), (1 << 20, 16), (16, 1 << 16)])
def test_series_that_cross_blocks(spark, block_rows, block_knots):
    rng = random.Random(2)
    rows, want = [], {}
    for key, n, share in (("a", 160, 0.5), ("b", 40, 0.9), (None, 30, 0.3), ("line", 9, 0.0), ("one", 6, 0.0), ("none", 4, 0.0)):
        y = [rng.gauss(0, 5) if rng.random() < share else None for _ in range(n)]
        if key == "line":
            y[2], y[6] = 1.0, 5.0
        if key == "one":
            y[3] = 2.0
        t = np.cumsum([rng.choice([1.0, 0.5, 3.0]) for _ in range(n)]).tolist()
        known = [i for i in range(n) if y[i] is not None]
        got = dense_spline(np.array([t[i] for i in known]), np.array([y[i] for i in known]), t)
        for i in range(n):
            rows.append((key, i, t[i], y[i], "kept"))
            want[key, i] = y[i] if y[i] is not None else got[i]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int, t double, y double, m string")
    out = sp.fill_cubic(df, ["i"], "y", ["k"], "t", block_rows, block_knots)
    assert out.columns == df.columns
    got = {(r.k, r.i): r.y for r in out.collect()}
    assert set(got) == set(want)
    for key, v in want.items():
        assert (got[key] is None) == (v is None) and (v is None or abs(got[key] - v) < 1e-9), key


def test_row_numbers_without_keys(spark):
    y = [None, 1.0, None, None, 4.0, 2.0, None, 0.0, None]
    df = spark.createDataFrame(list(enumerate(y)), "i int, y double")
    got = [r.y for r in sp.fill_cubic(df, ["i"], "y", block_rows=2, block_knots=2).orderBy("i").collect()]
    want = dense_spline(np.array([1.0, 4, 5, 7]), np.array([1.0, 4, 2, 0]), range(9))
    assert got[0] is None and got[8] is None
    assert all(abs(got[i] - want[i]) < 1e-9 for i in (2, 3, 6)) and got[4] == 4.0
    assert sp.fill_cubic(df.limit(0), ["i"], "y").count() == 0
