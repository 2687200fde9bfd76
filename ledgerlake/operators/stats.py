"""Statistics over all pairs of columns held long (one row per cell)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_KEYS = 512


def pairwise_corr(cells: DataFrame, key: str, at: str, value: str, block_keys: int = BLOCK_KEYS) -> DataFrame:
    """(key_i, key_j, corr): Pearson correlation of every two keys over the
    places ``at`` where both have a value, the diagonal included; null where
    fewer than two places are common or one side does not vary.

    Keys are cut into hashed blocks, and every unordered pair of blocks is one
    task of matrix products: no row per pair of keys and place.  Null and NaN
    values are absent; of several values at a place the smallest counts."""
    v = F.col(value).cast("double")
    c = cells.select(F.col(key).alias("k"), F.col(at).cast("string").alias("t"), F.nanvl(v, F.lit(None)).alias("v")).dropna()
    c = c.groupBy("k", "t").agg(F.min("v").alias("v"))
    kind = dict(c.dtypes)["k"]
    n = c.agg(F.approx_count_distinct("k", 0.02)).first()[0]
    blocks = max(1, -(-int(n) // block_keys))
    # Centred per key: the sums below then lose no digits to a large mean.
    c = c.join(c.groupBy("k").agg(F.avg("v").alias("m")), "k").select("k", "t", (F.col("v") - F.col("m")).alias("v"))
    c = c.withColumn("blk", F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int"))
    c = c.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    c = c.withColumns({"lo": F.least("blk", "other"), "hi": F.greatest("blk", "other")})

    def products(key, pdf):
        sides = [pdf[pdf["blk"] == x] for x in dict.fromkeys(int(x) for x in key)]
        places = np.unique(pdf["t"].to_numpy(dtype=object).astype(str))
        mats = []
        for s in sides:
            ids = np.unique(s["k"].to_numpy())
            x = np.zeros((len(ids), len(places)))
            m = np.zeros_like(x)
            at_ = (np.searchsorted(ids, s["k"].to_numpy()), np.searchsorted(places, s["t"].to_numpy(dtype=object).astype(str)))
            x[at_], m[at_] = s["v"], 1.0
            mats.append((ids, x, m))
        (a, x, mx), (b, y, my) = mats[0], mats[-1]
        cnt, sx, sy = mx @ my.T, x @ my.T, mx @ y.T
        with np.errstate(divide="ignore", invalid="ignore"):
            cov = x @ y.T - sx * sy / cnt
            vx, vy = (x * x) @ my.T - sx * sx / cnt, mx @ (y * y).T - sy * sy / cnt
            r = np.where((cnt > 1) & (vx > 0) & (vy > 0), cov / np.sqrt(vx * vy), np.nan)
        i, j = np.nonzero(cnt > 0)
        out = pd.DataFrame({"key_i": a[i], "key_j": b[j], "corr": r[i, j]})
        if len(sides) == 2:
            out = pd.concat([out, pd.DataFrame({"key_i": b[j], "key_j": a[i], "corr": r[i, j]})])
        return out

    found = c.groupBy("lo", "hi").applyInPandas(products, f"key_i {kind}, key_j {kind}, corr double")
    return found.withColumn("corr", F.nanvl("corr", F.lit(None)))
