"""
ties, nulls, all-null and constant columns, exact bin edges, unparseable
dates, the log offset carry, the prior-baseline volume rule and friends."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgerlake.functions.expr import bins_right_closed, clip, round_binary
from ledgerlake.operators import features as fe
from ledgerlake.operators import missing as mv
from ledgerlake.operators import monitor as mo
from ledgerlake.operators import outliers as ol
from ledgerlake.operators import scaling as sc
from ledgerlake.operators import text as tx
from ledgerlake.operators.ml import metrics as mt
from ledgerlake.operators.ml import models as md
from ledgerlake.operators.pipeline import merge_config
from ledgerlake.operators.recommend import block_neighbours, cf_predict_pairs
from ledgerlake.operators.stats import pairwise_corr
from ledgerlake.sources import files as fl
from ledgerlake.sources import html as hx


def rows(df, order=None):
    pdf = df.toPandas()
    return pdf.sort_values(order).reset_index(drop=True) if order else pdf


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, -5.0), (3, 50.0), (4, 5.0)], "id int, x double")
    out = rows(df.select("id", clip("x", 0, 10).alias("x")), "id")
    assert out.x.isna().tolist() == [True, False, False, False]
    assert out.x.tolist()[1:] == [0.0, 10.0, 5.0]


def test_mode_ties_and_all_null(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)],
                               "t string, u string")
    p = mv.fit_mode(df, ["t", "u"])
    assert p == {"t": "a", "u": "unknown"}


def test_group_fill_null_key_and_all_null_group(spark):
    df = spark.createDataFrame([("g1", 1.0), ("g1", None), ("g2", None), (None, None), ("g1", 3.0)],
                               "g string, x double")
    out = rows(mv.fill_group(df, "g", "mean", ["x"]).withColumn("i", F.monotonically_increasing_id()))
    got = {(r.g, r.x if r.x == r.x else None) for r in out.itertuples()}
    assert ("g1", 2.0) in got and ("g2", None) in got and (None, None) in got


def test_log_offset_carries_over(spark):
    df = spark.createDataFrame([(-3.0, 1.0), (2.0, 4.0)], "a double, b double")
    p = sc.fit_log(df, ["a", "b"])
    assert p["a"]["offset"] == 4.0 and p["b"]["offset"] == 4.0  # D8: b inherits the grown offset


def test_constant_column_minmax_and_inverse(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "x double, c double")
    out, p = sc.scale(df, "minmax", ["x", "c"])
    assert p["c"]["method"] == "constant"
    r = rows(out, "x")
    assert r.c.tolist() == [0.0, 0.0]
    back = rows(sc.inverse_transform(out, p), "x")
    assert back.x.tolist() == [1.0, 3.0] and back.c.tolist() == [0.0, 0.0]  # D9: no parameter to restore


@pytest.mark.parametrize("method", ["minmax", "zscore", "robust", "log"])
def test_inverse_of_scale_is_identity(spark, method):
    xs = [float(v) for v in np.random.RandomState(1).randn(50) * 10 + 3]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    out, p = sc.scale(df, method, ["x"])
    back = rows(sc.inverse_transform(out, p), "i")
    assert np.allclose(back.x.values, xs)


def test_bins_right_closed_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.15,), (0.150001,), (1.0,), (1.2,), (-0.1,)], "p double")
    out = [r[0] for r in df.select(bins_right_closed("p", [0, 0.15, 0.3, 0.5, 0.7, 1.0],
                                                     list("ABCDE")).alias("g")).collect()]
    assert out == ["A", "A", "B", "E", None, None]


def test_time_features_unparseable(spark):
    df = spark.createDataFrame([("2024-02-29 13:45:00",), ("not a date",), (None,)], "t string")
    out = fe.extract_time_features(df, "t").collect()
    assert out[0]["t_dayofweek"] == 3 and out[0]["t_is_month_end"] == 1 and out[0]["t_days_in_month"] == 29
    assert out[1]["t_year"] is None and out[2]["t_weekofyear"] is None


def test_label_encode_first_appearance(spark):
    df = spark.createDataFrame([(1, "z"), (2, "a"), (3, None), (4, "z"), (5, "m")], "o int, c string")
    out, _ = fe.label_encode(df, ["c"], ["o"])
    assert [r.c for r in out.orderBy("o").collect()] == [0, 1, None, 0, 2]


def test_onehot_null_all_zero_drop_first(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    out = fe.onehot_encode(df, ["c"])
    assert out.columns == ["c_b"]
    assert sorted(r.c_b for r in out.collect()) == [0, 0, 1]


def test_iqr_report_counts(spark):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in [1, 2, 3, 4, 100, None]], "x double")
    r = ol.iqr_report(df, ["x"]).collect()[0]
    assert r.q1 == 2.0 and r.q3 == 4.0 and r.outlier_count == 1 and r.outlier_pct == round(100 / 6, 2)


def test_volume_alert_uses_prior_baseline(spark):
    df = spark.createDataFrame([("s", 1, 10.0, 10.0), ("s", 2, 60.0, 10.0), ("s", 3, 20.0, None)],
                               "stock_code string, window_start int, avg_volume double, prior_baseline double")
    out = mo.volume_alerts(df).collect()
    assert len(out) == 1 and out[0].key == "s"  # D3: fires against the prior baseline


def test_high_freq_at_least(spark):
    df = spark.createDataFrame([(1, 8, 1, 9), (2, 7, 2, 9)], "account int, tx_count int, latest_tx int, window_start int")
    assert [r.key for r in mo.rule_high_freq(df).collect()] == ["1"]  # D23


def test_negative_word_with_plus_one_counts_negative(spark):
    lex = tx.Lexicon({"up": 2}, {"down": -2, "exhausted": 1}, pattern="[a-z]+", name="t")
    df = spark.createDataFrame([(1, "up exhausted down down")], "id int, text string")
    r = tx.analyse(df, "text", lex).collect()[0]
    assert r.positive_score == 2 and r.negative_score == 5 and r.polarity == "negative"  # D22


def test_pipeline_rejects_unknown_names():
    with pytest.raises(ValueError):
        merge_config({"outlier": {"action": "drop_everything"}})
    with pytest.raises(ValueError):
        merge_config({"normalization": {"method": "quantum"}})


def test_auc_matches_pairwise_definition(spark):
    rng = np.random.RandomState(3)
    y = rng.randint(0, 2, 300)
    s = np.round(rng.rand(300), 1)  # many ties
    df = spark.createDataFrame(pd.DataFrame({"label": y.astype(float), "score": s}))
    got = mt.roc_auc(df, "label", "score").first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    exp = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert math.isclose(got, exp, rel_tol=1e-12)


def test_class_report_zero_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    r = {x.cls: x for x in mt.class_report(df).collect()}
    assert r[0.0].precision == 0.0 and r[1.0].recall == 0.0 and r[1.0].miss_rate == 1.0


@pytest.mark.parametrize("block_users", [3, 7, 1024])
def test_block_neighbours_match_all_pairs(spark, block_users):
    rng = random.Random(4)
    rows = sorted({(u, i): (u, i, float(rng.randint(1, 5))) for u in range(20) for i in range(12) if rng.random() < 0.35 or i == 0}.values())
    m = spark.createDataFrame(rows + [(None, 1, 2.0), (3, None, 1.0), (99, 5, None)], "u int, i int, s double")
    vec = {u: {i: s for x, i, s in rows if x == u} for u in {r[0] for r in rows}}
    norm = {u: math.sqrt(sum(s * s for s in v.values())) for u, v in vec.items()}

    def sim(a, b):
        return sum(s * vec[b][i] for i, s in vec[a].items() if i in vec[b]) / (norm[a] * norm[b])

    def best(a, cand, k):
        x = sorted((-round(sim(a, b), 12), b) for b in cand if b != a and sim(a, b) > 0)
        return [b for _, b in x[:k]]

    got = {}
    for r in block_neighbours(m, "u", "i", "s", 4, block_users=block_users).collect():
        got.setdefault(r.a, {})[r.k] = r.b
        assert math.isclose(r.similarity, sim(r.a, r.b))
    assert {a: [b for _, b in sorted(v.items())] for a, v in got.items()} == {a: best(a, vec, 4) for a in vec if best(a, vec, 4)}
    raters = {i: [u for u in vec if i in vec[u]] for i in range(12)}
    want = {(u, i): best(u, raters[i], 3) for u in vec for i in range(12) if i not in vec[u] and best(u, raters[i], 3)}
    for targets in ("all", spark.createDataFrame([(u, i) for u in vec for i in range(12) if i not in vec[u]] + [(None, 1), (500, 1)], "u int, i int")):
        got = {}
        for r in block_neighbours(m, "u", "i", "s", 3, targets, block_users).collect():
            got.setdefault((r.a, r.target), {})[r.k] = r.b
            assert r.rating == vec[r.b][r.target]
        assert {k: [b for _, b in sorted(v.items())] for k, v in got.items()} == want


def test_predictions_without_neighbours(spark):
    tr = spark.createDataFrame([(1, 1, 4.0), (2, 2, 2.0)], "user_id int, item_id int, rating double")
    te = spark.createDataFrame([(1, 2, 0.0), (9, 1, 0.0), (1, 9, 0.0)], "user_id int, item_id int, rating double")
    got = {(r.user_id, r.item_id): r.prediction for r in cf_predict_pairs(tr, te).collect()}
    assert got == {(1, 2): 2.0, (9, 1): 0.0, (1, 9): 0.0}


def test_round_binary_matches_numpy(spark):
    vals = [168.175, 2.675, 0.125, 1.005, -2.675]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_binary("x", 2)).collect()]
    exp = [math.floor(abs(v) * 100 + 0.5) / 100 * (1 if v >= 0 else -1) for v in vals]
    assert got == exp


def _dbscan_brute(points, eps, least):
    near = {i: [j for j in points if math.dist(points[i], points[j]) <= eps] for i in points}
    core = {i for i in points if len(near[i]) >= least}
    label = {}
    for i in sorted(core):
        if i in label:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in label:
                label[x] = i
                todo += [y for y in near[x] if y in core]
    return {i: label.get(i, min((label[j] for j in near[i] if j in core), default=-1)) for i in points}


@pytest.mark.parametrize("cell_points", [7, 1024])
def test_dbscan_against_brute_force(spark, cell_points):
    rng = random.Random(6)
    points = {i: (0.9 * i, 0.0) for i in range(120)}                       # one chain
    points |= {200 + i: (rng.gauss(0, 3), 50 + rng.gauss(0, 3)) for i in range(60)}
    points |= {300 + i: (5.0, 100.0 + 2 * i) for i in range(20)}           # same first coordinate, no neighbours
    points |= {400 + i: (7.0, 200.0 + 0.01 * i) for i in range(25)}
    points |= {500 + i: (-40.0, 7.0) for i in range(90)}                   # a third of the points are copies
    points |= {600: (-40.5, 7.0), 601: (-41.2, 7.0), 602: (-39.1, 7.0)}
    df = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in points.items()], ["id", "v"])
    for least in (2, 4):
        got = {r.id: r.cluster for r in md.dbscan(df, "id", "v", 1.0, least, cell_points).collect()}
        assert got == _dbscan_brute(points, 1.0, least)


def test_smote_rows_neighbours_and_keys(spark):
    rng = random.Random(2)
    rows = [(i, 1.0, [rng.random(), rng.random()]) for i in range(7)] + [(1000 + i, 0.0, [rng.random(), 5.0]) for i in range(53)]
    df = spark.createDataFrame([(i, y, Vectors.dense(v)) for i, y, v in rows], ["id", "y", "v"])
    for k in (3, 20):
        out = md.smote(df, "id", "y", "v", 1.0, 0.5, k).collect()
        assert len(out) == 26 - 7 and len({r.id for r in out}) == len(out)
        assert min(r.id for r in out) > max(i for i, _, _ in rows) and {r.y for r in out} == {1.0}
        few = {i: v for i, y, v in rows if y == 1.0}
        for r in out:   # on a segment between a point and one of its nearest
            assert any(abs(math.dist(few[a], r.v) + math.dist(r.v, few[b]) - math.dist(few[a], few[b])) < 1e-9
                       for a in few for b in sorted((x for x in few if x != a), key=lambda x: math.dist(few[a], few[x]))[:k])
    assert md.smote(df, "id", "y", "v", 1.0, 0.1).count() == 0


def test_silhouette_of_all_points(spark):
    rng = np.random.default_rng(5)
    pts, lab = rng.normal(size=(40, 3)), rng.integers(0, 3, 40)
    lab[0] = 9      # a cluster of one
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    want = []
    for i in range(40):
        means = {c: d[i][(lab == c) & (np.arange(40) != i)] for c in set(lab)}
        if not len(means[lab[i]]):
            want.append(0.0)
            continue
        a, b = means[lab[i]].mean(), min(m.mean() for c, m in means.items() if c != lab[i] and len(m))
        want.append((b - a) / max(a, b))
    df = spark.createDataFrame([(i, int(c), p.tolist()) for i, (c, p) in enumerate(zip(lab, pts))], "id long, c int, v array<double>")
    got = mt.silhouette(df, "id", "c", "v").first()
    assert got.points == 40 and math.isclose(got.silhouette, np.mean(want), rel_tol=1e-9)


def test_pairwise_corr_against_numpy(spark):
    rng = random.Random(9)
    cells = {(k, t): 1000 + rng.gauss(0, 1) for k in "abcdefg" for t in range(30) if rng.random() < 0.7}
    cells |= {("const", t): 5.0 for t in range(30)} | {("once", 3): 1.0}
    df = spark.createDataFrame([(k, t, v) for (k, t), v in cells.items()] + [("a", 99, None), (None, 1, 2.0)], "k string, t int, v double")
    for block in (2, 512):
        got = {(r.key_i, r.key_j): r.corr for r in pairwise_corr(df, "k", "t", "v", block).collect()}
        keys = {k for k, _ in cells}
        for a in keys:
            for b in keys:
                both = [t for t in range(30) if (a, t) in cells and (b, t) in cells]
                x, y = [cells[a, t] for t in both], [cells[b, t] for t in both]
                if len(both) > 1 and "const" not in (a, b):
                    assert math.isclose(got[a, b], np.corrcoef(x, y)[0, 1], rel_tol=1e-6)
                elif both:
                    assert got[a, b] is None
                else:
                    assert (a, b) not in got


def test_interpolation_methods_match_pandas(spark):
    vals = [None, 1.0, None, None, 4.0, None, 8.0, float("nan"), None]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, x double")
    s = pd.Series(vals, dtype=float)
    want = {"linear": s.interpolate("linear"), "pad": s.ffill(), "bfill": s.bfill()}
    for m, w in want.items():
        got = [r.x for r in mv.fill_interpolate(df, ["i"], ["x"], method=m).orderBy("i").collect()]
        assert [None if math.isnan(v) else v for v in w] == got, m
    near = [r.x for r in mv.fill_interpolate(df, ["i"], ["x"], method="nearest").orderBy("i").collect()]
    assert near == [None, 1.0, 1.0, 4.0, 4.0, 4.0, 8.0, None, None]
    with pytest.raises(ValueError):
        mv.fill_interpolate(df, ["i"], method="cubic")


def test_html_links_titles_and_open_elements(spark):
    html = """<A HREF='/a/../b'>One</A><a href="x?y">T<b>w</b>o
    lines</a><a href=//h.org/p>Three</a><a name=q>no link</a><a href="#f">frag</a><a href="mailto:a@b">mail</a><a href="http://z/">  </a>
    <h1 class=t>Big
    <i>title</i> &amp; more</h1><div class="content">left <script>no</script>open"""
    df = spark.createDataFrame([(1, "http://s.com/d/e.html", html), (2, None, None)], "page_id long, url string, html string")
    got = {(r.pos, r.title.split()[0], r.link) for r in hx.links(df).collect()}
    assert got == {(0, "One", "http://s.com/b"), (1, "Two", "http://s.com/d/x?y"), (2, "Three", "http://h.org/p")}
    t = {r.page_id: r.title for r in hx.titles(df).collect()}
    assert t[1].split() == ["Big", "title", "&", "more"] and t[2] is None
    assert {r.title for r in hx.titles(df, ["div.content"]).collect() if r.title} == {"left open"}
    assert hx.first_match(html, ["div.content"]) == "left\nopen"


def test_encodings_and_json_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,t\n1,é增\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("id,t\n2,增长\n".encode("gbk"))
    (tmp_path / "c.csv").write_bytes("\ufeffid,t\n3,x\n".encode("utf-8"))
    got = {r.id: r.t for r in fl.load_csv(spark, str(tmp_path), schema="id int, t string").collect()}
    assert got == {1: "é增", 2: "增长", 3: "x"}
    assert fl.first_encoding([b"\xc3", b"\xa9"], ["utf-8"]) == "utf-8" and fl.first_encoding([b"\xff"], ["utf-8"]) is None
    j = tmp_path / "j"
    j.mkdir()
    (j / "1.json").write_text('[{"a":1},{"a":2}]\n[{"a":3}]\n')
    (j / "2.json").write_text('\n[\n  {"a": 4},\n  {"a": 5}\n]\n')
    assert sorted(r.a for r in fl.load_json(spark, str(j), "a int").collect()) == [1, 2, 3, 4, 5]
    (j / "3.json").write_text("[{broken\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        fl.load_json(spark, str(j), "a int").collect()


def test_longest_dictionary_match(spark):
    df = spark.createDataFrame([("业绩大增长利空出尽的新能源超预期",)], "t string")
    r = tx.analyse(df, "t", tx.FINANCE_ZH).first()
    assert r.tokens == ["业绩大增", "利空出尽", "新能源", "超预期"]
    assert tx.analyse(df.select(F.lit("增长超预期").alias("t")), "t", tx.FINANCE_ZH).first().tokens == ["增长超预期"]
