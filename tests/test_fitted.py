"""Fits kept as rows: merging equals fitting the whole, sketches within their
error, new data without the old."""

import math
import random

import numpy as np

from ledgerlake.operators import fitted as ft
from ledgerlake.operators import scaling as sc


def frame(spark, rows):
    return spark.createDataFrame(rows, "a double, b double, c int, d string")


def rows_of(seed, n):
    rng = random.Random(seed)
    return [(1e6 + rng.gauss(0, 1), None if rng.random() < 0.2 else rng.expovariate(0.1), rng.randint(0, 5), "x") for _ in range(n)]


def test_merged_parts_equal_the_whole(spark, tmp_path):
    rows = rows_of(1, 900) + [(float("nan"), 3.0, None, "y")]
    path = str(tmp_path / "state")
    for part in (rows[:10], rows[10:500], rows[500:]):
        ft.save_state(ft.fit_state(frame(spark, part)), path)
    got = {r.column: r for r in ft.statistics(ft.load_state(spark, path)).collect()}
    whole = {r.column: r for r in ft.statistics(ft.fit_state(frame(spark, rows))).collect()}
    assert set(got) == {"a", "b", "c"}
    for i, c in enumerate("abc"):
        v = np.array([r[i] for r in rows if r[i] is not None and not math.isnan(r[i])])
        for s in (got[c], whole[c]):
            assert (s.n, s.nulls, s.lo, s.hi) == (len(v), len(rows) - len(v), v.min(), v.max())
            assert math.isclose(s["mean"], v.mean(), rel_tol=1e-14) and math.isclose(s.std, v.std(ddof=1), rel_tol=1e-9)
            # No more values than the sketch holds: exact.
            assert np.allclose([s.q_25, s.q_50, s.q_75], np.quantile(v, [0.25, 0.5, 0.75]), rtol=1e-12)


def test_parameters_equal_those_fitted_on_the_data(spark):
    rows = rows_of(2, 500)
    df = frame(spark, rows)
    state = ft.merge_states(ft.fit_state(frame(spark, rows[:100])), ft.fit_state(frame(spark, rows[100:])))
    for method in ("minmax", "zscore", "robust"):
        got, want = ft.scaler_params(state, method), sc.FITTERS[method](df, ["a", "b", "c"])
        assert set(got) == set(want)
        for c in want:
            for k, v in want[c].items():
                assert got[c][k] == v if isinstance(v, (str, list)) else math.isclose(got[c][k], v, rel_tol=1e-9), (method, c, k)
    assert ft.exact_params(df, ["b"]) == sc.fit_robust(df, ["b"])
    assert abs(ft.fill_values(state, "median")["b"] - np.median([r[1] for r in rows if r[1] is not None])) < 1e-9
    low, high = ft.outlier_bounds(state)["b"]
    assert low < 0 < high


def test_sketch_error_on_many_values(spark):
    rng = random.Random(3)
    v = [rng.gauss(0, 1) for _ in range(30_000)]
    parts = [ft.fit_state(spark.createDataFrame([(x,) for x in v[i::5]], "a double"), k=200) for i in range(5)]
    s = ft.statistics(ft.merge_states(*parts), [0.05, 0.5, 0.95]).first()
    for p, q in ((0.05, s.q_5), (0.5, s.q_50), (0.95, s.q_95)):
        assert abs(sum(x <= q for x in v) / len(v) - p) < 0.02


def test_empty_constant_and_unknown(spark):
    df = frame(spark, [(5.0, None, None, "x"), (5.0, None, 1, "x")])
    state = ft.fit_state(df)
    assert ft.scaler_params(state, "robust") == {"a": {"method": "constant", "value": 0.0}, "c": {"method": "constant", "value": 0.0}}
    assert ft.scaler_params(ft.merge_states(state, ft.fit_state(df.limit(0))), "zscore")["a"] == {"method": "constant", "value": 0.0}
    assert ft.fill_values(ft.fit_state(df.limit(0))) == {}
    assert ft.fit_state(df.select("d")).count() == 0
