"""Distributed order primitives against pandas, with tiny blocks so every
cross-block path (halo, carries, EWM block joins) is exercised."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import ordered as O


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.RandomState(7)
    n = 240
    pdf = pd.DataFrame({"k": np.repeat([1, 2, 3], [150, 2, 88]), "t": np.arange(n),
                        "x": rng.randn(n) * 10 + 50})
    pdf.loc[rng.rand(n) < 0.3, "x"] = np.nan
    sdf = spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None)))
    return pdf, sdf


@pytest.mark.parametrize("exact_path", [True, False])
def test_quantiles_match_numpy(spark, frame, exact_path):
    pdf, sdf = frame
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    limit = 0 if exact_path else None
    got = O.exact_quantiles(sdf, ["x", "t"], probs, map_limit=limit).toPandas()
    for c in ("x", "t"):
        exp = pdf[c].dropna().quantile(probs).values
        g = got[got.column == c].sort_values("prob").value.values
        assert np.allclose(g, exp, rtol=1e-12)


def test_grouped_quantiles(spark, frame):
    pdf, sdf = frame
    got = O.exact_quantiles(sdf, ["x"], [0.5], by=["k"], map_limit=0).toPandas().set_index("k")["value"]
    exp = pdf.groupby("k").x.median()
    for k in exp.index:
        assert np.isclose(got[k], exp[k])


def test_dense_index_is_a_permutation(spark, frame):
    _, sdf = frame
    ix = O.dense_index(sdf, ["t"]).toPandas().sort_values("t")
    assert list(ix["_idx"]) == list(range(len(ix)))


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_fills_across_blocks(spark, frame, keys):
    pdf, sdf = frame
    bl = O.blocked(sdf, ["t"], keys, block_rows=7).where(~F.col("_halo"))
    ff = O.carry_fill(bl, ["x"], keys, True).toPandas().sort_values("t")
    bf = O.carry_fill(bl, ["x"], keys, False).toPandas().sort_values("t")
    if keys:
        eff, ebf = pdf.groupby("k").x.ffill(), pdf.groupby("k").x.bfill()
    else:
        eff, ebf = pdf.x.ffill(), pdf.x.bfill()
    assert np.allclose(ff.x.fillna(-1).values, eff.fillna(-1).values)
    assert np.allclose(bf.x.fillna(-1).values, ebf.fillna(-1).values)


def test_halo_lag_rolling_lead(spark, frame):
    pdf, sdf = frame
    d = sdf.fillna(0.0)
    p = pdf.fillna(0.0)
    out = O.ordered_window_apply(
        d, ["t"], ["k"],
        lambda w: [F.lag("x", 3).over(w).alias("lag3"), F.avg("x").over(w.rowsBetween(-4, 0)).alias("m5"),
                   F.lead("x", 1).over(w).alias("nxt")],
        back=4, fwd=1, block_rows=6).toPandas().sort_values("t")
    g = p.groupby("k").x
    assert np.allclose(out.lag3.fillna(-1).values, g.shift(3).fillna(-1).values)
    assert np.allclose(out.m5.values, g.transform(lambda s: s.rolling(5, min_periods=1).mean()).values)
    assert np.allclose(out.nxt.fillna(-1).values, g.shift(-1).fillna(-1).values)


@pytest.mark.parametrize("alpha", [0.9, 2 / 13])
def test_ewm_exact(spark, frame, alpha):
    pdf, sdf = frame
    d = sdf.fillna(1.0)
    p = pdf.fillna(1.0)
    out = O.ewm(d, "x", alpha, ["t"], ["k"]).toPandas().sort_values("t")
    exp = p.groupby("k").x.transform(lambda s: s.ewm(alpha=alpha, adjust=False).mean())
    assert np.abs(out["ewm"].values - exp.values).max() < 1e-9


@pytest.mark.parametrize("limit,accuracy", [(None, None), (1, 10000), (0, 20), (30, 100)])
def test_quantile_params_narrow_their_brackets(spark, monkeypatch, limit, accuracy):
    rng = np.random.RandomState(11)
    n = 20000
    pdf = pd.DataFrame({"cont": rng.randn(n) * 100, "tied": rng.randint(0, 5, n).astype(float),
                        "skew": np.where(rng.rand(n) < 0.9, 1.0, rng.rand(n))})
    sdf = spark.createDataFrame(pdf)
    if limit is not None:  # many rounds: wide first brackets, few values collected
        monkeypatch.setattr(O, "BRACKET_LIMIT", limit)
        monkeypatch.setattr(O, "BRACKET_ACCURACY", accuracy)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = O.quantile_params(sdf, ["cont", "tied", "skew"], probs)
    for c in ("cont", "tied", "skew"):
        exp = pdf[c].quantile(probs).values
        assert np.allclose([got[c][p] for p in probs], exp, rtol=1e-12, atol=1e-12), c


def test_quantiles_of_clipped_columns_need_no_further_pass(spark, monkeypatch):
    import numpy as np

    from ledgerlake.operators import outliers as ol
    from ledgerlake.operators import scaling as sc
    from ledgerlake.operators.pipeline import PreprocessingPipeline
    rng = np.random.default_rng(7)
    rows = [(i, float(rng.lognormal()), int(rng.integers(0, 5)), None if i % 7 == 0 else float(rng.normal() ** 3),
             float("nan") if i % 50 == 0 else float(i % 90)) for i in range(9000)]
    df = spark.createDataFrame(rows, "id long, skew double, tied int, gaps double, nans double")
    few = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 1e9)], "id long, x double")
    for frame, columns in ((df, ["id", "skew", "tied", "gaps", "nans"]), (few, ["id", "x"]), (df, ["id", "skew", "tied", "gaps"])):
        for method, factor in (("iqr", 1.5), ("iqr", 0.0), ("iqr", -0.2), ("quantile", 1.5)):
            out, bounds, known = ol.clip_and_quantiles(frame, columns, method, factor, sc.robust_probs())
            assert set(known) == ({"id", "tied"} if "nans" in columns else set(columns))
            assert sc.fit_robust(out, columns, known=known) == sc.fit_robust(out, columns)
            assert bounds == ol.clip_outliers(frame, columns, method, factor)[1]
    asked = []
    real = sc.quantile_params
    monkeypatch.setattr(sc, "quantile_params", lambda d, c, *a: asked.append(list(c)) or real(d, c, *a))
    PreprocessingPipeline(order=["id"]).run(df.drop("nans"))
    assert asked == []
