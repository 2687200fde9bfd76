"""Second-order boosting against a numpy rendering that sees all rows."""

import numpy as np
import pytest

from ledgerlake.operators.ml import boosting as bt


def plain_fit(x, y, edges, p):
    """The same trees by recursion over row sets, sums in floats."""
    bins = np.stack([bt.to_bins(x[:, f], e) for f, e in enumerate(edges)], axis=1)
    margin = np.full(len(y), p.base)

    def grow(rows, depth):
        g, h = bt.gradients(margin[rows], y[rows], p.objective)
        best = None
        if depth:
            whole = g.sum() ** 2 / (h.sum() + p.l2)
            for f, e in enumerate(edges):
                b = bins[rows, f]
                gone = b == len(e) + 1
                for k in range(len(e)):
                    for missing_left in (True, False) if gone.any() else (True,):
                        left = (b <= k) | (gone & missing_left) if missing_left else (b <= k) & ~gone
                        hl, hr = h[left].sum(), h[~left].sum()
                        if hl < p.min_child or hr < p.min_child:
                            continue
                        gain = (g[left].sum() ** 2 / (hl + p.l2) + g[~left].sum() ** 2 / (hr + p.l2) - whole) / 2 - p.gamma
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-7):
                            best = (gain, left)
        if best is None:
            out[rows] = -g.sum() / (h.sum() + p.l2) * p.rate
            return
        grow(rows[best[1]], depth - 1)
        grow(rows[~best[1]], depth - 1)

    for _ in range(p.rounds):
        out = np.zeros(len(y))
        grow(np.arange(len(y)), p.depth)
        margin = margin + out
    return margin


def rows_of(seed, n, missing=0.1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    x[:, 3] = rng.integers(0, 3, n)
    score = np.sin(2 * x[:, 0]) + x[:, 1] * (x[:, 3] > 0) - 0.5
    x[rng.random((n, 4)) < missing] = np.nan
    return x, score, rng


def frame(spark, x, y, parts):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double").repartition(parts)


@pytest.mark.parametrize("objective,rounds,depth", [("logistic", 10, 3), ("squared", 4, 4)])
def test_equal_to_numpy(spark, objective, rounds, depth):
    x, score, rng = rows_of(1, 500)
    y = (rng.random(500) < 1 / (1 + np.exp(-3 * score))).astype(float) if objective == "logistic" else score * 40
    p = bt.Params(objective, rounds, depth, rate=0.3, l2=1.5, gamma=0.02)
    model = bt.fit(frame(spark, x, y, 3), list("abcd"), "y", p, max_bins=8)
    got = {r.id: r.margin for r in model.transform(frame(spark, x, y, 2)).collect()}
    want = plain_fit(x, y, model.edges, p)
    assert np.allclose([got[i] for i in range(500)], want, atol=1e-4 if objective == "logistic" else 1e-2)
    shares = dict(model.importances())
    assert abs(sum(shares.values()) - 1) < 1e-9 and shares["c"] < shares["a"]


def test_same_trees_for_any_layout(spark):
    x, score, _ = rows_of(2, 400)
    y = (score > 0).astype(float)
    p = bt.Params(rounds=3, depth=3)
    trees = [bt.fit(frame(spark, x, y, n), list("abcd"), "y", p, max_bins=10).trees for n in (1, 5)]
    assert trees[0] == trees[1]


def test_held_out_accuracy_and_regularisation(spark):
    x, score, _ = rows_of(3, 900, missing=0.0)
    y = (score > 0).astype(float)
    train, test = frame(spark, x[:600], y[:600], 2), frame(spark, x[600:], y[600:], 2)
    model = bt.fit(train, list("abcd"), "y", bt.Params(rounds=12, depth=4, rate=0.3))
    rows = model.transform(test).collect()
    assert np.mean([r.prediction == r.y for r in rows]) > 0.9
    assert all(abs(r.probability - 1 / (1 + np.exp(-r.margin))) < 1e-12 for r in rows)
    strict = bt.fit(train, list("abcd"), "y", bt.Params(rounds=2, depth=4, gamma=1e9))
    assert all(t.feature == [-1] for t in strict.trees)


def test_odd_inputs(spark):
    none = spark.createDataFrame([], "a double, y double")
    assert bt.fit(none, ["a"], "y").trees == []
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (None, 1.0), (1.0, None), (float("nan"), 1.0)], "a double, y double")
    model = bt.fit(flat, ["a"], "y", bt.Params(rounds=1, depth=2, min_child=0.1, l2=0.0))
    by = {r.a if r.a == r.a else None: r.margin for r in model.transform(flat).collect()}
    assert by[None] > 0 and by[1.0] == 0


def test_rows_are_stored_as_few_blocks(spark, monkeypatch):
    stored = []

    def kept(df):
        out = materialize(df)
        stored.append((out.rdd.getNumPartitions(), out.count()))
        return out

    from ledgerlake.functions.ordered import materialize
    x, score, _ = rows_of(4, 3000)
    y = (score > 0).astype(float)
    p = bt.Params(rounds=9, depth=2)
    df = frame(spark, x, y, 64)
    monkeypatch.setattr(bt, "materialize", kept)
    model = bt.fit(df, list("abcd"), "y", p, max_bins=8)
    assert stored == [(1, 1), (1, 1)]
    monkeypatch.setattr(bt, "PART_ROWS", 300)
    assert bt.parts_of(3000, 4) == 10
    assert bt.fit(df, list("abcd"), "y", p, max_bins=8).trees == model.trees


def test_walk_by_tables():
    tree = bt.Tree([1, -1, 0, -1, -1], [2, 0, 0, 0, 0], [False, True, True, True, True], [1, -1, 3, -1, -1], [0.0, 1, 2, 3, 4], [0.0] * 5)
    bins = np.array([[0, 1, 0, 2, 1], [2, 0, 3, 4, 4]], dtype=np.uint8)      # missing: 2 and 4
    assert tree.leaves(bins, np.array([2, 4])).tolist() == [1, 1, 3, 3, 4]
