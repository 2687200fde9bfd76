"""Principal components without a Gram matrix.

Subspace iteration: a pass over the rows multiplies the centred rows with a
basis of a few columns and back, ``X' (X V)``; tasks return sums of the size of
the basis, which are added up in blocks of features.  The driver holds the basis
(features x ``basis``) and turns it by a small eigenproblem, until the residual of
the wanted components is below ``tolerance`` of the first.  With no more features
than columns in the basis the first pass is already exact."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.ordered import materialize
from ...session import ship_package

BASIS = 64
BLOCK = 1024          # features whose sums travel as one row
TOLERANCE = 1e-7
MAX_PASSES = 100


@dataclass
class Components:
    """Mean, components (features x k, the entry of the greatest size is
    positive), their variances, the whole variance, passes, residual."""
    mean: np.ndarray
    vectors: np.ndarray
    variances: np.ndarray
    total: float
    rows: int
    passes: int
    residual: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.total) if self.total > 0 else 0.0 for v in self.variances]

    def transform(self, df: DataFrame, vec: Column, out: str = "pca") -> DataFrame:
        """``df`` with the components of every row; null for null vectors."""
        ship_package(df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast((self.mean, self.vectors))     # features x k

        @F.pandas_udf("array<double>")
        def project(xs):
            import pandas as pd
            mean, v = shared.value
            ok = xs.notna().to_numpy()
            rows = np.full((len(xs), v.shape[1]), np.nan)
            if ok.any():
                rows[ok] = (np.stack(xs[ok].to_numpy()) - mean) @ v
            return pd.Series([r.tolist() if o else None for r, o in zip(rows, ok)])

        return df.withColumn(out, project(vec))


def _rows_of(batch) -> np.ndarray:
    x = batch.column(0)
    return x.flatten().to_numpy().reshape(len(x), -1)


def _summed(rows: DataFrame, partial, width: int, n: int) -> np.ndarray:
    """The sum over tasks of an array (n features x width)."""
    def run(batches):
        total = np.zeros((n, width))
        for batch in batches:
            if batch.num_rows:
                partial(_rows_of(batch), total)
        for at in range(0, n, BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([at // BLOCK]), pa.array([total[at:at + BLOCK].ravel()], pa.list_(pa.float64()))], names=["b", "v"])

    def add(pdf):
        import pandas as pd
        return pd.DataFrame({"b": [int(pdf["b"].iloc[0])], "v": [np.sum(np.stack(pdf.sort_values("part")["v"].to_numpy()), axis=0)]})

    parts = rows.mapInArrow(run, "b long, v array<double>").withColumn("part", F.spark_partition_id())
    out = np.zeros((n, width))
    # Features x width numbers, in rows of a block.
    for r in parts.groupBy("b").applyInPandas(add, "b long, v array<double>").collect():
        block = np.array(r["v"]).reshape(-1, width)
        out[r["b"] * BLOCK:r["b"] * BLOCK + len(block)] = block
    return out


def pca(df: DataFrame, vec: Column, k: int = 2, basis: int = BASIS, tolerance: float = TOLERANCE, max_passes: int = MAX_PASSES,
        seed: int = 42) -> Components:
    """The first ``k`` principal components of the vectors (array<double>, all of
    one length; rows with a null vector are left out)."""
    ship_package(df.sparkSession)
    x = materialize(df.select(vec.alias("x")).where("x IS NOT NULL"))
    first = x.select(F.size("x").alias("n")).first()
    if first is None:
        return Components(np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0, 0, 0, 0.0)
    n = first["n"]
    k, width = min(k, n), min(n, max(basis, 2 * k))

    def moments(rows, total):
        total[:, 0] += rows.sum(axis=0)
        total[:, 1] += len(rows)

    sums = _summed(x, moments, 2, n)
    count = int(sums[0, 1])
    mean = sums[:, 0] / count
    free = max(count - 1, 1)

    def squares(rows, total):
        total[:, 0] += ((rows - mean) ** 2).sum(axis=0)

    whole = float(_summed(x, squares, 1, n).sum()) / free
    v = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, width)))[0] if width < n else np.eye(n)
    passes, residual = 0, np.inf
    while True:
        def both_ways(rows, total, v=v):
            c = rows - mean
            total += c.T @ (c @ v)

        w = _summed(x, both_ways, width, n) / free
        passes += 1
        small = v.T @ w
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values, kind="stable")
        values, turn = values[order], turn[:, order]
        best = v @ turn[:, :k]
        residual = float(np.linalg.norm(w @ turn[:, :k] - best * values[:k], axis=0).max(initial=0.0))
        if width == n or passes >= max_passes or residual <= tolerance * max(values[0], 1e-300):
            break
        v = np.linalg.qr(w @ turn)[0]
    largest = best[np.abs(best).argmax(axis=0), np.arange(k)]
    best = best * np.where(largest < 0, -1.0, 1.0)
    return Components(mean, best, np.maximum(values[:k], 0.0), whole, count, passes, residual)
