"""Principal components against numpy's singular vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.ml import subspace as ss


def frame(spark, x):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(-1, None)], "id long, x array<double>").repartition(3)


def plain(x, k):
    c = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    v = vt[:k].T
    v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1, 1)
    return v, s[:k] ** 2 / (len(x) - 1), (c ** 2).sum() / (len(x) - 1)


@pytest.mark.parametrize("n,d,basis", [(200, 12, 64), (150, 300, 20), (60, 2500, 12)])
def test_equal_to_numpy(spark, n, d, basis):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 6)) @ rng.normal(size=(6, d)) * 3 + rng.normal(size=(n, d)) * 0.3 + 100
    m = ss.pca(frame(spark, x), F.col("x"), 3, basis)
    v, variances, total = plain(x, 3)
    assert np.allclose(m.vectors, v, atol=1e-5) and np.allclose(m.variances, variances, rtol=1e-8)
    assert np.allclose(m.explained, variances / total, rtol=1e-8)
    assert (m.passes == 1) == (d <= basis) and m.residual <= 1e-6 * variances[0]
    rows = {r.id: r.pca for r in m.transform(frame(spark, x), F.col("x")).collect()}
    assert rows[-1] is None
    assert np.allclose([rows[i] for i in range(n)], (x - x.mean(axis=0)) @ m.vectors, atol=1e-8)


def test_ten_thousand_columns(spark):
    """The driver's share is features x basis, no features x features."""
    rng = np.random.default_rng(2)
    x = np.outer(rng.normal(size=40), rng.normal(size=10_000)) + 0.05 * rng.normal(size=(40, 10_000))
    m = ss.pca(frame(spark, x), F.col("x"), 1, basis=4)
    assert m.vectors.shape == (10_000, 1) and np.allclose(m.vectors, plain(x, 1)[0], atol=1e-5)


def test_odd_inputs(spark):
    none = spark.createDataFrame([], "x array<double>")
    assert ss.pca(none, F.col("x")).rows == 0
    same = spark.createDataFrame([([1.0, 2.0],)] * 3, "x array<double>")
    m = ss.pca(same, F.col("x"), 5)
    assert m.explained == [0.0, 0.0] and m.rows == 3
