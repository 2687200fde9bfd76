"""Model queries: classification on the credit features, clustering on
embeddings, regression on lineitem and stock features, recommendation on
ratings (C, G, R, B, A1-A3, A13, A14, O4).  Metric queries over fixed
predictions or fixed labels have DuckDB oracles; fitted models are
rows-only checks."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions.expr import bins_right_closed
from ..functions.ordered import materialize
from ..operators.ml import boosting as bt
from ..operators.ml import metrics as mt
from ..operators.ml import models as md
from ..operators.ml.subspace import pca
from ..operators.ml.ward import ward
from ..sources.tables import table
from .credit import CTES as CREDIT_CTES
from .credit import FEATURE_SQL, GRADE_EDGES, GRADE_LABELS, credit_frame, with_risk_label
from .registry import register
from .views import V_BARS_SQL, v_bars, v_loan, v_rating, with_ctes

CREDIT_FEATURES = ["age", "annual_income", "gender_code", "education_code", "credit_history_length",
                   "total_overdue", "num_overdue_90d", "debt_income_ratio", "payment_income_ratio",
                   "credit_card_utilization", "has_mortgage", "num_credit_cards", "num_dependents", "num_loans",
                   "has_overdue", "severe_overdue"]


def credit_labelled(spark, sf_dir):
    df, _ = with_risk_label(credit_frame(spark, sf_dir))
    return df.na.fill(0, subset=CREDIT_FEATURES).withColumn("label", F.col("default_label").cast("double"))


def credit_split(spark, sf_dir):
    s = md.stratified_split(credit_labelled(spark, sf_dir), "customer_id", "label", 0.25)
    s = md.assemble(s, CREDIT_FEATURES)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    tr, te, _ = md.scale_features(train, test)
    return tr, te


def _credit_sql(body: str) -> str:
    return with_ctes("", **CREDIT_CTES).rstrip() + ",\n" + FEATURE_SQL + ",\n" + body


@register("stratified_split", _credit_sql("""
lab AS (SELECT customer_id, CAST(CASE WHEN risk_score > q30 THEN 1 ELSE 0 END AS DOUBLE) AS label FROM f, q)
SELECT customer_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(CAST(customer_id AS VARCHAR) || '42'), customer_id) - 1
  < round(count(*) OVER (PARTITION BY label) * 0.25) THEN 'test' ELSE 'train' END AS split FROM lab"""))
def stratified_split(spark, sf_dir):
    """Deterministic stratified 75/25 split (md5 order per class)."""
    s = md.stratified_split(credit_labelled(spark, sf_dir), "customer_id", "label", 0.25)
    return s.select("customer_id", "label", "split")


_SPLIT_SQL = """
lab AS (SELECT *, CAST(CASE WHEN risk_score > q30 THEN 1 ELSE 0 END AS DOUBLE) AS label FROM f, q),
sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(CAST(customer_id AS VARCHAR) || '42'), customer_id) - 1
  < round(count(*) OVER (PARTITION BY label) * 0.25) THEN 'test' ELSE 'train' END AS split FROM lab),
st AS (SELECT """ + ", ".join(
    f"avg(coalesce({c}, 0)) AS m_{c}, stddev_pop(coalesce({c}, 0)) AS s_{c}" for c in CREDIT_FEATURES) + " FROM sp WHERE split = 'train')"


@register("ml_scale", _credit_sql(_SPLIT_SQL + " SELECT customer_id, split, " + ", ".join(
    f"round(CASE WHEN s_{c} = 0 THEN 0 ELSE (coalesce({c}, 0) - m_{c}) / s_{c} END, 6) AS {c}" for c in CREDIT_FEATURES) + " FROM sp, st"))
def ml_scale(spark, sf_dir):
    """Features standardised with train statistics (population std)."""
    tr, te = credit_split(spark, sf_dir)
    x = vector_to_array("scaled")
    return tr.unionByName(te).select("customer_id", "split", *[F.round(x[i], 6).alias(c) for i, c in enumerate(CREDIT_FEATURES)])


def _one(spark, sf_dir, name):
    tr, te = credit_split(spark, sf_dir)
    return md.compare_classifiers(tr, te, len(CREDIT_FEATURES), [name])


@register("clf_lr")
def clf_lr(spark, sf_dir):
    """Logistic regression (C = 1) metrics on the test split."""
    return _one(spark, sf_dir, "logistic_regression")


@register("clf_rf")
def clf_rf(spark, sf_dir):
    """C4: random forest (100 trees, depth 10)."""
    return _one(spark, sf_dir, "random_forest")


@register("clf_gbt")
def clf_gbt(spark, sf_dir):
    """Boosted trees (100 rounds, depth 6, rate 0.1)."""
    return _one(spark, sf_dir, "gbt")


BOOST_COLUMNS = ["debt_income_ratio", "age", "num_loans", "total_overdue"]
BOOST_EDGES = [[0.1, 0.5, 1.0], [25, 35, 45, 55], [6, 8, 10, 12], [2, 4, 6, 8, 10, 12]]
# The first round at probability 1/2: gradients 1/2 - y, Hessians 1/4.
BOOST_GAIN_SQL = _credit_sql("""
lab AS (SELECT *, CAST(CASE WHEN risk_score > q30 THEN 1 ELSE 0 END AS DOUBLE) AS label FROM f, q),
cut AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {e}::DOUBLE AS edge, sum(CASE WHEN coalesce({c}, 0) <= {e} THEN 0.5 - label ELSE 0 END) AS gl, "
    f"0.25 * count(*) FILTER (coalesce({c}, 0) <= {e}) AS hl, sum(0.5 - label) AS g, 0.25 * count(*) AS h FROM lab"
    for c, es in zip(BOOST_COLUMNS, BOOST_EDGES) for e in es) + """)
SELECT feature, edge, round((gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) / 2, 4) AS gain
FROM cut WHERE hl >= 1 AND h - hl >= 1""")


@register("boost_split_gains", BOOST_GAIN_SQL)
def boost_split_gains(spark, sf_dir):
    """Gains of all first splits on fixed bins (logistic, L2 1)."""
    df = credit_labelled(spark, sf_dir)
    params = bt.Params(rounds=0)
    model = bt.fit(df, BOOST_COLUMNS, "label", params, edges=BOOST_EDGES)
    tree = bt.Tree()
    root = tree.add(0.0)
    sums = bt.histograms(bt.binned_rows(df, BOOST_COLUMNS, "label", model.edges, 0.0), model.edges, params, [], tree, [root], 1.0)[root]
    rows = [(BOOST_COLUMNS[f], float(BOOST_EDGES[f][b]), round(gain, 4)) for gain, f, b, _ in bt.split_gains(*sums, model.edges, params)]
    return spark.createDataFrame(rows, "feature string, edge double, gain double")


# One-feature stumps: a row per step holds the margins of the bins.
_STUMP_EDGES, _STUMP_ROUNDS = BOOST_EDGES[-1], 4
BOOST_STUMPS_SQL = _credit_sql(f"""
lab AS (SELECT coalesce(total_overdue, 0) AS x, CAST(CASE WHEN risk_score > q30 THEN 1 ELSE 0 END AS DOUBLE) AS y FROM f, q),
b AS (SELECT CASE {' '.join(f'WHEN x <= {e} THEN {i}' for i, e in enumerate(_STUMP_EDGES))} ELSE {len(_STUMP_EDGES)} END AS bin, y FROM lab),
n AS (SELECT i AS bin, count(y) AS n, coalesce(sum(y), 0) AS y FROM (SELECT unnest(range({len(_STUMP_EDGES) + 1})) AS i) LEFT JOIN b ON b.bin = i GROUP BY i),
s AS (SELECT list(n ORDER BY bin) AS n, list(y ORDER BY bin) AS y, list(0.0::DOUBLE ORDER BY bin) AS m, 0 AS step FROM n),
steps AS (
  WITH RECURSIVE t AS (
    SELECT n, y, m, step FROM s
    UNION ALL (
    WITH gh AS (SELECT *, list_transform(range(1, len(n) + 1), lambda i: n[i] / (1 + exp(-m[i])) - y[i]) AS g,
                  list_transform(range(1, len(n) + 1), lambda i: n[i] / (1 + exp(-m[i])) * (1 - 1 / (1 + exp(-m[i])))) AS h FROM t WHERE step < {_STUMP_ROUNDS}),
    cuts AS (SELECT *, unnest(range(1, len(n))) AS k FROM gh),
    sums AS (SELECT *, list_sum(g[1:k]) AS gl, list_sum(h[1:k]) AS hl, list_sum(g) AS ga, list_sum(h) AS ha FROM cuts),
    gains AS (SELECT *, (gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1)) / 2 AS gain FROM sums WHERE hl >= 1 AND ha - hl >= 1),
    best AS (SELECT * FROM gains WHERE gain > 0 ORDER BY gain DESC, k LIMIT 1)
    SELECT n, y, list_transform(range(1, len(n) + 1), lambda i: m[i] + 0.3 * CASE WHEN i <= k THEN -gl / (hl + 1) ELSE -(ga - gl) / (ha - hl + 1) END) AS m, step + 1 FROM best))
  SELECT * FROM t)
SELECT CAST(i - 1 AS INTEGER) AS bin, CAST(n[i] AS BIGINT) AS n, round(m[i], 4) AS margin
FROM (SELECT *, unnest(range(1, len(n) + 1)) AS i FROM steps WHERE step = {_STUMP_ROUNDS}) WHERE n[i] > 0""")


@register("boost_stumps", BOOST_STUMPS_SQL)
def boost_stumps(spark, sf_dir):
    """Four rounds of one-feature stumps on fixed bins: margin of every bin."""
    df = credit_labelled(spark, sf_dir)
    model = bt.fit(df, BOOST_COLUMNS[-1:], "label", bt.Params(rounds=_STUMP_ROUNDS, depth=1, rate=0.3), edges=[_STUMP_EDGES])
    x = F.col(BOOST_COLUMNS[-1])
    bin_of = F.lit(len(_STUMP_EDGES))
    for i, e in reversed(list(enumerate(_STUMP_EDGES))):
        bin_of = F.when(x <= e, F.lit(i)).otherwise(bin_of)
    return model.transform(df).groupBy(bin_of.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("margin"), 4).alias("margin"))


@register("clf_boost2")
def clf_boost2(spark, sf_dir):
    """Second-order boosting (30 rounds, depth 4, L2 1) on the test split."""
    s = md.stratified_split(credit_labelled(spark, sf_dir), "customer_id", "label", 0.25)
    model = bt.fit(s.where(F.col("split") == "train"), CREDIT_FEATURES, "label", bt.Params(rounds=30, depth=4, rate=0.3))
    out = materialize(model.transform(s.where(F.col("split") == "test")).select("label", "prediction", "probability"))
    return mt.classification_metrics(out, "label", "prediction", "probability")


@register("clf_svm_rff")
def clf_svm_rff(spark, sf_dir):
    """RBF SVM via random Fourier features + LinearSVC + Platt."""
    return _one(spark, sf_dir, "svm_rbf")


@register("clf_compare")
def clf_compare(spark, sf_dir):
    """The four classifiers ranked by weighted F1."""
    tr, te = credit_split(spark, sf_dir)
    return md.compare_classifiers(tr, te, len(CREDIT_FEATURES))


@register("clf_cv")
def clf_cv(spark, sf_dir):
    """5-fold accuracy of logistic regression on the TRAIN part."""
    tr, _ = credit_split(spark, sf_dir)
    tr = materialize(md.hash_folds(tr, "customer_id", 5))
    n = tr.count()
    rows = []
    for k in range(5):
        m = md.classifiers(n)["logistic_regression"].fit(tr.where(F.col("fold") != k))
        acc = mt.classification_metrics(m.transform(tr.where(F.col("fold") == k))).first()["accuracy"]
        rows.append((k, float(acc)))
    mean = sum(a for _, a in rows) / len(rows)
    std = (sum((a - mean) ** 2 for _, a in rows) / len(rows)) ** 0.5
    return spark.createDataFrame([(k, a, mean, std) for k, a in rows],
                                 "fold int, accuracy double, mean_accuracy double, std_accuracy double")


@register("clf_importance")
def clf_importance(spark, sf_dir):
    """Random-forest feature importances, 4 dp, largest first."""
    tr, _ = credit_split(spark, sf_dir)
    m = md.classifiers(tr.count())["random_forest"].fit(tr)
    return spark.createDataFrame(md.importances(m, CREDIT_FEATURES), "feature string, importance double") \
        .orderBy(F.desc("importance"), "feature")


@register("clf_predict")
def clf_predict(spark, sf_dir):
    """C11: predictions of the fitted logistic model on the test split."""
    tr, te = credit_split(spark, sf_dir)
    m = md.classifiers(tr.count())["logistic_regression"].fit(tr)
    return m.transform(te).select("customer_id", "label", "prediction",
                                  vector_to_array("probability")[1].alias("p_default"))


FIXED_PRED_SQL = "lab AS (SELECT customer_id, CAST(CASE WHEN risk_score > q30 THEN 1 ELSE 0 END AS DOUBLE) AS label, " \
                 "CAST(has_overdue AS DOUBLE) AS prediction, debt_income_ratio AS score FROM f, q)"


def fixed_predictions(spark, sf_dir):
    """Fixed (model-free) predictions for metric oracles: has_overdue as
    the predicted class, the debt-to-income ratio as the score."""
    df = credit_labelled(spark, sf_dir)
    return df.select("customer_id", "label", F.col("has_overdue").cast("double").alias("prediction"),
                     F.col("debt_income_ratio").alias("score"))


@register("clf_metrics", _credit_sql(FIXED_PRED_SQL + """,
rep AS (SELECT cls, support, tp, pred_n,
  CASE WHEN pred_n > 0 THEN tp * 1.0 / pred_n ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN tp * 1.0 / support ELSE 0 END AS recall FROM (
  SELECT c.cls, coalesce(s.support, 0) AS support, coalesce(t.tp, 0) AS tp, coalesce(p.pred_n, 0) AS pred_n
  FROM (SELECT label AS cls FROM lab UNION SELECT prediction FROM lab) c
  LEFT JOIN (SELECT label AS cls, count(*) AS support FROM lab GROUP BY 1) s USING (cls)
  LEFT JOIN (SELECT label AS cls, count(*) AS tp FROM lab WHERE label = prediction GROUP BY 1) t USING (cls)
  LEFT JOIN (SELECT prediction AS cls, count(*) AS pred_n FROM lab GROUP BY 1) p USING (cls))),
auc AS (SELECT sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM (
  SELECT score, pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
  FROM (SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
        FROM lab GROUP BY score)))
SELECT round(sum(tp) * 1.0 / sum(support), 6) AS accuracy,
  round(sum(precision * support) / sum(support), 6) AS precision,
  round(sum(recall * support) / sum(support), 6) AS recall,
  round(sum(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END * support)
        / sum(support), 6) AS f1,
  round(max(auc.auc), 6) AS auc
FROM rep, auc"""))
def clf_metrics(spark, sf_dir):
    """Accuracy, weighted P/R/F1 and AUC on fixed predictions."""
    m = mt.classification_metrics(fixed_predictions(spark, sf_dir), "label", "prediction", "score")
    return m.select(*[F.round(c, 6).alias(c) for c in ["accuracy", "precision", "recall", "f1", "auc"]])


@register("confusion_report", _credit_sql(FIXED_PRED_SQL + """
SELECT c.cls, coalesce(s.support, 0) AS support, coalesce(t.tp, 0) AS tp, coalesce(p.predicted_n, 0) AS predicted_n,
  round(CASE WHEN coalesce(p.predicted_n, 0) > 0 THEN coalesce(t.tp, 0) * 1.0 / p.predicted_n ELSE 0 END, 6) AS precision,
  round(CASE WHEN coalesce(s.support, 0) > 0 THEN coalesce(t.tp, 0) * 1.0 / s.support ELSE 0 END, 6) AS recall,
  round(CASE WHEN coalesce(s.support, 0) > 0 AND coalesce(p.predicted_n, 0) > 0 AND coalesce(t.tp, 0) > 0
             THEN 2.0 * t.tp / (s.support + p.predicted_n) ELSE 0 END, 6) AS f1,
  round(CASE WHEN coalesce(s.support, 0) > 0 THEN (s.support - coalesce(t.tp, 0)) * 1.0 / s.support ELSE 0 END, 6)
    AS miss_rate
FROM (SELECT label AS cls FROM lab UNION SELECT prediction FROM lab) c
LEFT JOIN (SELECT label AS cls, count(*) AS support FROM lab GROUP BY 1) s USING (cls)
LEFT JOIN (SELECT label AS cls, count(*) AS tp FROM lab WHERE label = prediction GROUP BY 1) t USING (cls)
LEFT JOIN (SELECT prediction AS cls, count(*) AS predicted_n FROM lab GROUP BY 1) p USING (cls)"""))
def confusion_report(spark, sf_dir):
    """Per class precision, recall, F1, support, miss rate."""
    r = mt.class_report(fixed_predictions(spark, sf_dir))
    return r.select("cls", "support", "tp", "predicted_n",
                    *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1", "miss_rate"]])


@register("class_weights", _credit_sql("""
lab AS (SELECT CAST(CASE WHEN risk_score > q30 THEN 1 ELSE 0 END AS DOUBLE) AS label FROM f, q)
SELECT label, count(*) AS n_c, round((SELECT count(*) FROM lab) * 1.0 / (2 * count(*)), 6) AS weight
FROM lab GROUP BY label"""))
def class_weights(spark, sf_dir):
    """Balanced class weights n / (k * n_c)."""
    w = md.class_weights(credit_labelled(spark, sf_dir))
    return w.select("label", "n_c", F.round("weight", 6).alias("weight"))


# Three classes with a fixed score each.
_OVR = {0: "debt_income_ratio", 1: "credit_card_utilization", 2: "payment_income_ratio"}


@register("clf_auc_ovr", _credit_sql("""
lab AS (SELECT customer_id % 3 AS cls, * FROM f), per AS (""" + " UNION ALL ".join(
    f"SELECT {c} AS k, coalesce({s}, 0) AS score, cls = {c} AS y FROM lab" for c, s in _OVR.items()) + """),
g AS (SELECT k, score, count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg FROM per GROUP BY k, score),
b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY k ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT round(avg(auc), 6) AS auc FROM (SELECT k, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM b GROUP BY k)"""))
def clf_auc_ovr(spark, sf_dir):
    """One-vs-rest AUC over three classes with fixed scores."""
    df = credit_labelled(spark, sf_dir).withColumn("cls", F.pmod("customer_id", F.lit(3)))
    df = materialize(df.select("cls", *_OVR.values()))
    return spark.createDataFrame([(round(mt.roc_auc_ovr(df, "cls", _OVR), 6),)], "auc double")


@register("clf_recall_first")
def clf_recall_first(spark, sf_dir):
    """SMOTE on the train part, balanced weights, depths 8 and 4,
    recall of the defaulters, best model by recall."""
    tr, te = credit_split(spark, sf_dir)
    return md.compare_for_recall(materialize(tr), materialize(te), "customer_id")


@register("credit_grades")
def credit_grades(spark, sf_dir):
    """Default probability of every customer by the model of the best F1
    on the test part -> grades A-E (right-closed bins) -> count and percent
    per grade and per part (D14: train and test rows are told apart)."""
    tr, te = (md.stored_for_fits(x, "customer_id") for x in credit_split(spark, sf_dir))
    ranked, fitted = md.fit_classifiers(tr, te, len(CREDIT_FEATURES), list(md.classifiers(1)))
    best = ranked.where(F.col("rank") == 1).first()["model"]
    p = fitted[best].transform(tr.unionByName(te)).withColumn("p", vector_to_array("probability")[1])
    g = materialize(p.groupBy("split", bins_right_closed("p", GRADE_EDGES, GRADE_LABELS).alias("credit_grade")).agg(
        F.count(F.lit(1)).alias("customers")))
    of = g.groupBy("split").agg(F.sum("customers").alias("_n"))
    return g.join(of, "split").select(F.lit(best).alias("model"), "split", "credit_grade", "customers",
                                      F.round(F.col("customers") * 100.0 / F.col("_n"), 2).alias("pct"))


# ------------------------------------------------------------ clustering
DIM = 64


def embeddings(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").alias("vec"),
                    array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def _dist_sql(a: str, b: str) -> str:
    return f"sqrt(list_sum(list_transform(range(1, {DIM + 1}), lambda i: ({a}[i]::DOUBLE - {b}[i]::DOUBLE) ** 2)))"


@register("silhouette", f"""
WITH s AS (SELECT vec_id AS sk, label AS sc, embedding AS sv FROM embeddings),
per AS (SELECT sk, sc, e.label, avg({_dist_sql('sv', 'e.embedding')}) AS md FROM s JOIN embeddings e ON e.vec_id <> s.sk
        GROUP BY sk, sc, e.label),
ab AS (SELECT sk, max(CASE WHEN label = sc THEN md END) AS a, min(CASE WHEN label <> sc THEN md END) AS b FROM per GROUP BY sk)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, count(*) AS points FROM ab""")
def silhouette(spark, sf_dir):
    """Euclidean silhouette of the embedding labels over all points."""
    s = mt.silhouette(embeddings(spark, sf_dir), "vec_id", "label", "vec")
    return s.select(F.round("silhouette", 6).alias("silhouette"), "points")


def _mean_sql(i):
    return f"avg(embedding[{i + 1}]::DOUBLE)"


CEN_SQL = ("SELECT label, count(*) AS n, [" + ", ".join(_mean_sql(i) for i in range(DIM)) + "] AS m "
           "FROM embeddings GROUP BY label")


@register("calinski", f"""
WITH c AS ({CEN_SQL}),
g AS (SELECT [{', '.join(f'sum(n * m[{i + 1}]) / sum(n)' for i in range(DIM))}] AS gm, sum(n) AS nn, count(*) AS k FROM c),
b AS (SELECT sum(n * list_sum(list_transform(range(1, {DIM + 1}), lambda i: (m[i] - gm[i]) ** 2))) AS b FROM c, g),
w AS (SELECT sum(list_sum(list_transform(range(1, {DIM + 1}), lambda i: (e.embedding[i]::DOUBLE - c.m[i]) ** 2))) AS w
      FROM embeddings e JOIN c USING (label))
SELECT round((b / (k - 1)) / (w / (nn - k)), 6) AS calinski_harabasz FROM b, w, g""")
def calinski(spark, sf_dir):
    """Calinski-Harabasz of the embedding labels."""
    return mt.calinski_harabasz(embeddings(spark, sf_dir), "label", "vec", DIM) \
        .select(F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


@register("davies_bouldin", f"""
WITH c AS ({CEN_SQL}),
s AS (SELECT label, avg({_dist_sql('e.embedding', 'c.m')}) AS s FROM embeddings e JOIN c USING (label) GROUP BY label),
cs AS (SELECT c.label, m, s FROM c JOIN s USING (label)),
r AS (SELECT a.label, max((a.s + b.s) / {_dist_sql('a.m', 'b.m')}) AS r FROM cs a JOIN cs b ON a.label <> b.label GROUP BY a.label)
SELECT round(avg(r), 6) AS davies_bouldin FROM r""")
def davies_bouldin(spark, sf_dir):
    """Davies-Bouldin of the embedding labels."""
    return mt.davies_bouldin(embeddings(spark, sf_dir), "label", "vec", DIM) \
        .select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


PROFILE_DIMS = DIM


@register("cluster_profile", "SELECT label AS cluster, count(*) AS n, " + ", ".join(
    f"round(avg(embedding[{i + 1}]::DOUBLE), 4) AS f{i}" for i in range(PROFILE_DIMS)) + " FROM embeddings GROUP BY label")
def cluster_profile(spark, sf_dir):
    """A1: per cluster mean of the features (4 dp) and row count."""
    e = embeddings(spark, sf_dir)
    return e.groupBy(F.col("label").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.avg(F.col("vec")[i].cast("double")), 4).alias(f"f{i}")
                                        for i in range(PROFILE_DIMS)])


@register("cluster_profile_full", "SELECT label AS cluster, " + ", ".join(
    x for i in range(PROFILE_DIMS) for x in (
        f"round(avg(embedding[{i + 1}]::DOUBLE), 6) AS f{i}_mean", f"round(stddev_samp(embedding[{i + 1}]::DOUBLE), 6) AS f{i}_std",
        f"round(min(embedding[{i + 1}]::DOUBLE), 6) AS f{i}_min", f"round(max(embedding[{i + 1}]::DOUBLE), 6) AS f{i}_max"))
    + " FROM embeddings WHERE label >= 0 GROUP BY label")
def cluster_profile_full(spark, sf_dir):
    """A2: per cluster mean, std, min, max per feature; noise (-1) excluded."""
    e = embeddings(spark, sf_dir).where(F.col("label") >= 0)
    aggs = []
    for i in range(PROFILE_DIMS):
        x = F.col("vec")[i].cast("double")
        aggs += [F.round(F.avg(x), 6).alias(f"f{i}_mean"), F.round(F.stddev_samp(x), 6).alias(f"f{i}_std"),
                 F.round(F.min(x), 6).alias(f"f{i}_min"), F.round(F.max(x), 6).alias(f"f{i}_max")]
    return e.groupBy(F.col("label").alias("cluster")).agg(*aggs)


@register("segment_names", """SELECT cluster, CASE WHEN f0 > 0.01 AND f1 > 0.01 THEN 'growth'
  WHEN f0 > 0.01 THEN 'value' WHEN f1 > 0.01 THEN 'defensive' ELSE 'distressed' END AS segment FROM (
  SELECT label AS cluster, avg(embedding[1]::DOUBLE) AS f0, avg(embedding[2]::DOUBLE) AS f1 FROM embeddings GROUP BY label)""")
def segment_names(spark, sf_dir):
    """A3: a segment label from thresholds on the cluster averages."""
    e = embeddings(spark, sf_dir)
    p = e.groupBy(F.col("label").alias("cluster")).agg(F.avg(F.col("vec")[0].cast("double")).alias("f0"),
                                                       F.avg(F.col("vec")[1].cast("double")).alias("f1"))
    seg = (F.when((F.col("f0") > 0.01) & (F.col("f1") > 0.01), "growth").when(F.col("f0") > 0.01, "value")
            .when(F.col("f1") > 0.01, "defensive").otherwise("distressed"))
    return p.select("cluster", seg.alias("segment"))


@register("cluster_kmeans")
def cluster_kmeans(spark, sf_dir):
    """G1: k-means (k = 10) best of 10 seeds."""
    e = embeddings(spark, sf_dir)
    m = md.kmeans_best(e, 10, 10)
    return m.transform(e).select("vec_id", "cluster")


DBSCAN_EPS, DBSCAN_MIN = 1.2, 5


# Recursive reachability from every core point; small tables only.
DBSCAN_SQL = f"""
WITH RECURSIVE near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b
    ON list_sum(list_transform(range(1, {DIM + 1}), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ** 2)) <= {DBSCAN_EPS ** 2}),
core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {DBSCAN_MIN}),
ce AS (SELECT a, b FROM near WHERE a IN (FROM core) AND b IN (FROM core)),
reach AS (SELECT id, id AS label FROM core UNION SELECT ce.b, reach.label FROM reach JOIN ce ON ce.a = reach.id),
lab AS (SELECT id, min(label) AS label FROM reach GROUP BY id),
border AS (SELECT near.a AS id, min(lab.label) AS label FROM near JOIN lab ON lab.id = near.b GROUP BY near.a)
SELECT e.vec_id, CAST(coalesce(lab.label, border.label, -1) AS BIGINT) AS cluster
FROM embeddings e LEFT JOIN lab ON lab.id = e.vec_id LEFT JOIN border ON border.id = e.vec_id"""


@register("cluster_dbscan", DBSCAN_SQL)
def cluster_dbscan(spark, sf_dir):
    """Exact DBSCAN (eps 1.2, min 5 incl. self) on joins; noise -1."""
    return md.dbscan(embeddings(spark, sf_dir), "vec_id", "features", DBSCAN_EPS, DBSCAN_MIN)


WARD_K = 10


# One merge of the cheapest pair a step; small tables only.
WARD_SQL = f"""
WITH RECURSIVE c AS (
  SELECT vec_id AS id, list_transform(embedding, lambda v: v::DOUBLE) AS x, 1.0::DOUBLE AS w, [vec_id] AS members, count(*) OVER () AS n FROM embeddings
  UNION ALL (
  WITH p AS (SELECT a.id AS i, b.id AS j, a.w * b.w / (a.w + b.w) * list_distance(a.x, b.x) ** 2 AS cost FROM c a JOIN c b ON a.id < b.id),
  best AS (SELECT arg_min({{'i': i, 'j': j}}, cost) AS m FROM p WHERE (SELECT count(*) FROM c) > {WARD_K}),
  gone AS (SELECT x, w, members, m.i AS into_id, m.j AS j FROM c, best WHERE id = m.j)
  SELECT c.id, CASE WHEN c.id = into_id THEN list_transform(range(1, {DIM + 1}), lambda k: (c.w * c.x[k] + gone.w * gone.x[k]) / (c.w + gone.w)) ELSE c.x END,
    CASE WHEN c.id = into_id THEN c.w + gone.w ELSE c.w END, CASE WHEN c.id = into_id THEN list_concat(c.members, gone.members) ELSE c.members END, n - 1
  FROM c, gone WHERE c.id <> j))
SELECT unnest(members) AS vec_id, CAST(cluster AS INTEGER) AS cluster FROM (
  SELECT members, row_number() OVER (ORDER BY id) - 1 AS cluster FROM c WHERE n = (SELECT min(n) FROM c))"""


@register("cluster_ward", WARD_SQL)
def cluster_ward(spark, sf_dir):
    """Exact Ward clusters (k = 10), numbered by their smallest ids."""
    return ward(embeddings(spark, sf_dir), "vec_id", vector_to_array("features"), WARD_K)


@register("kmeans_search")
def kmeans_search(spark, sf_dir):
    """Inertia, silhouette and Calinski-Harabasz for k = 2..10, with the
    choice of each criterion (elbow = largest second difference, D13)."""
    rows = md.kmeans_search(md.stored_for_fits(embeddings(spark, sf_dir), "vec_id"))
    inertia = [r[1] for r in rows]
    second = [None] + [inertia[i - 1] - 2 * inertia[i] + inertia[i + 1] for i in range(1, len(rows) - 1)] + [None]
    elbow = max((s, r[0]) for s, r in zip(second, rows) if s is not None)[1]
    by_sil, by_ch = max(rows, key=lambda r: r[2])[0], max(rows, key=lambda r: r[3])[0]
    return spark.createDataFrame([(*r, r[0] == elbow, r[0] == by_sil, r[0] == by_ch) for r in rows],
                                 "k int, inertia double, silhouette double, calinski_harabasz double, elbow boolean, "
                                 "best_silhouette boolean, best_calinski boolean")


@register("cluster_compare")
def cluster_compare(spark, sf_dir):
    """K-means, DBSCAN and Ward side by side: cluster count and sizes,
    noise ratio, silhouette (squared-distance evaluator), Calinski-Harabasz
    and Davies-Bouldin, noise excluded."""
    e = md.stored_for_fits(embeddings(spark, sf_dir), "vec_id").persist()
    fits = {"kmeans": lambda: md.kmeans_best(e, 10).transform(e).select("vec_id", "cluster"),
            "dbscan": lambda: md.dbscan(e, "vec_id", "features", DBSCAN_EPS, DBSCAN_MIN),
            "ward": lambda: ward(e, "vec_id", vector_to_array("features"), WARD_K)}

    def row(name):
        lab = fits[name]()
        j = materialize(e.join(lab, "vec_id").select("vec", "features", F.col("cluster").cast("int").alias("cluster")))
        core = j.where(F.col("cluster") >= 0)
        sizes = sorted((r["n"] for r in core.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
        n, k = j.count(), len(sizes)
        many = k > 1
        return (name, k, sizes, (n - sum(sizes)) / n if n else 0.0,
                md.silhouette_sq(core, "features", "cluster") if many else None,
                mt.calinski_harabasz(core, "cluster", "vec", DIM).first()[0] if many else None,
                mt.davies_bouldin(core, "cluster", "vec", DIM).first()[0] if many else None)

    # Each is a chain of short jobs: side by side they use the cores.
    with ThreadPool(len(fits)) as pool:
        rows = pool.map(inheritable_thread_target(spark)(row), list(fits))
    e.unpersist()
    out = spark.createDataFrame(rows, "model string, clusters int, sizes array<long>, noise_ratio double, silhouette double, "
                                      "calinski_harabasz double, davies_bouldin double")
    return out.orderBy(F.desc_nulls_last("silhouette"))


def _top_vector_sql(name: str, matrix: str) -> str:
    """CTEs <name>_v (i, v) and <name>_l (value): the first eigenvector of the
    table ``matrix`` (i, j, v), by squaring it until only this one is left."""
    return f"""
{name}_p AS (WITH RECURSIVE p AS (
    SELECT i, j, v / (SELECT sum(v) FROM {matrix} WHERE i = j) AS v, 0 AS step FROM {matrix}
    UNION ALL (WITH q AS (SELECT a.i, b.j, sum(a.v * b.v) AS v, max(a.step) + 1 AS step FROM p a JOIN p b ON a.j = b.i WHERE a.step < 24 GROUP BY a.i, b.j)
      SELECT i, j, v / sum(CASE WHEN i = j THEN v ELSE 0 END) OVER () AS v, step FROM q))
  SELECT i, j, v FROM p WHERE step = 24),
{name}_c AS (SELECT i, v FROM {name}_p WHERE j = (SELECT arg_max(i, v) FROM {name}_p WHERE i = j)),
{name}_v AS (SELECT i, v / sqrt(sum(v * v) OVER ()) * sign(arg_max(v, abs(v)) OVER ()) AS v FROM {name}_c),
{name}_l AS (SELECT sum(a.v * m.v * b.v) AS value FROM {matrix} m JOIN {name}_v a ON a.i = m.i JOIN {name}_v b ON b.i = m.j)"""


PCA_SQL = f"""
WITH x AS MATERIALIZED (SELECT vec_id, unnest(range(1, {DIM + 1})) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
c AS MATERIALIZED (SELECT vec_id, x.i, x.v - m.v AS v FROM x JOIN (SELECT i, avg(v) AS v FROM x GROUP BY i) m USING (i)),
g AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.v * b.v) / (SELECT count(*) - 1 FROM embeddings) AS v FROM c a JOIN c b USING (vec_id) GROUP BY a.i, b.i),
{_top_vector_sql("one", "g")},
g2 AS MATERIALIZED (SELECT g.i, g.j, g.v - (SELECT value FROM one_l) * a.v * b.v AS v FROM g JOIN one_v a ON a.i = g.i JOIN one_v b ON b.i = g.j),
{_top_vector_sql("two", "g2")}
SELECT vec_id, round(sum(c.v * a.v), 5) AS pc1, round(sum(c.v * b.v), 5) AS pc2,
  round((SELECT value FROM one_l) / (SELECT sum(v) FROM g WHERE i = j), 6) AS explained_1,
  round((SELECT value FROM two_l) / (SELECT sum(v) FROM g WHERE i = j), 6) AS explained_2
FROM c JOIN one_v a ON a.i = c.i JOIN two_v b ON b.i = c.i GROUP BY vec_id"""


@register("pca2", PCA_SQL)
def pca2(spark, sf_dir):
    """Two centred principal components with explained variance."""
    e = embeddings(spark, sf_dir)
    m = pca(e, vector_to_array("features"), 2)
    out = m.transform(e, vector_to_array("features"))
    return out.select("vec_id", F.round(F.col("pca")[0], 5).alias("pc1"), F.round(F.col("pca")[1], 5).alias("pc2"),
                      *[F.lit(round(x, 6)).alias(f"explained_{i}") for i, x in enumerate(m.explained, 1)])


SMOTE_SQL = f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings),
s AS (SELECT count(*) FILTER (label = 0) AS a, count(*) FILTER (label <> 0) AS b, max(vec_id) AS top FROM e),
need AS (SELECT greatest(CAST(floor(0.5 * b) AS BIGINT) - a, 0) AS need, a, top FROM s),
m AS (SELECT vec_id AS p, x, row_number() OVER (ORDER BY md5(vec_id || '{md.SEED}'), vec_id) - 1 AS i FROM e WHERE label = 0),
nb AS (SELECT a.p, b.x AS qx, row_number() OVER (PARTITION BY a.p ORDER BY list_distance(a.x, b.x), b.p) AS j FROM m a JOIN m b ON a.p <> b.p),
r AS (SELECT p, x, i, need // a AS each, need % a AS extra, a, top, unnest(range((need // a) + CASE WHEN i < need % a THEN 1 ELSE 0 END)) AS r FROM m, need),
u AS (SELECT *, ('0x' || substr(md5('{md.SEED}#' || p || '#' || r), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM r)
SELECT top + 1 + i * each + least(i, extra) + r AS vec_id, 1 AS y, list_transform(range(1, {DIM + 1}), lambda k: x[k] + u * (qx[k] - x[k])) AS vec
FROM u JOIN nb ON nb.p = u.p AND nb.j = r % least(5, a - 1) + 1"""


@register("smote", SMOTE_SQL)
def smote(spark, sf_dir):
    """C14: synthetic rows for the minority label 0 until it is half the
    majority (exact neighbours, k = 5)."""
    e = embeddings(spark, sf_dir).withColumn("y", (F.col("label") == 0).cast("int"))
    out = md.smote(e, "vec_id", "y", "features", 1, 0.5, 5)
    return out.select("vec_id", "y", vector_to_array("features").alias("vec"))


@register("outlier_iforest")
def outlier_iforest(spark, sf_dir):
    """Isolation forest (100 trees of 256 rows) over the loan frame."""
    v = v_loan(spark, sf_dir)
    return md.isolation_forest(
            v.withColumn("_rid", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")),
            "_rid", ["income", "credit_score", "debt_ratio", "tax", "loan_amount"])


# ------------------------------------------------------------ regression
@register("reg_linear", """SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept FROM lineitem""")
def reg_linear(spark, sf_dir):
    """Ordinary least squares (normal equations) of extended price on
    quantity."""
    li = md.assemble(table(spark, sf_dir, "lineitem"), ["l_quantity"])
    from pyspark.ml.regression import LinearRegression
    m = LinearRegression(featuresCol="features", labelCol="l_extendedprice", solver="normal", regParam=0.0).fit(li)
    return spark.createDataFrame([(round(float(m.coefficients[0]), 6), round(float(m.intercept), 6))],
                                 "slope double, intercept double")


# The stock case's feature list (fixed values).
STOCK_X = ["close", "volume", "close_lag_1", "close_lag_2", "close_lag_3", "close_lag_5", "volume_lag_1", "volume_lag_5",
           "close_ma_5", "close_ma_10", "close_ma_20", "close_std_5", "close_std_10", "volume_ma_5", "volume_ma_10",
           "ma5", "ma10", "ma20", "rsi_14", "macd_dif", "macd_dea", "macd_hist", "pct_change", "high_low_ratio",
           "close_open_ratio"]
STOCK_GBT_DEPTH = 4


def stock_split(spark, sf_dir, test_frac: float = 0.2):
    """25 features -> next close; time-ordered split (latest 20% of
    dates are test)."""
    from ..operators.series import technical_indicators
    f = technical_indicators(v_bars(spark, sf_dir)).withColumn("label", F.col("target_next_close"))
    cut = f.select(F.percentile_approx(F.unix_date("trade_date"), 1 - test_frac, 10000)).first()[0]
    f = md.assemble(f, STOCK_X)
    train, test = f.where(F.unix_date("trade_date") <= cut), f.where(F.unix_date("trade_date") > cut)
    tr, te, _ = md.scale_features(train, test)
    return tr, te


def _reg(spark, sf_dir, which):
    tr, te = stock_split(spark, sf_dir)
    return md.compare_regressors(tr, te, 1.0, 0.01, which, STOCK_GBT_DEPTH)


@register("reg_ridge")
def reg_ridge(spark, sf_dir):
    """R2: ridge (alpha 1) on the stock features."""
    return _reg(spark, sf_dir, ["ridge"])


@register("reg_lasso")
def reg_lasso(spark, sf_dir):
    """Lasso (alpha 0.01, the case's value)."""
    return _reg(spark, sf_dir, ["lasso"])


@register("reg_gbt")
def reg_gbt(spark, sf_dir):
    """Boosted regression trees (100 rounds, depth 4, rate 0.1)."""
    return _reg(spark, sf_dir, ["gbdt"])


@register("reg_compare")
def reg_compare(spark, sf_dir):
    """The four regressors ranked by R2."""
    return _reg(spark, sf_dir, None)


@register("stock_forecast")
def stock_forecast(spark, sf_dir):
    """Next-close predictions of every model on the test dates."""
    tr, te = (materialize(x) for x in stock_split(spark, sf_dir))
    st = tr.agg(F.stddev_pop("label").alias("s"), F.count(F.lit(1)).alias("n")).first()
    out = None
    for name, model in md.regressors(1.0, 0.01, st["s"], st["n"], STOCK_GBT_DEPTH).items():
        p = model.fit(tr).transform(te).select("stock_code", "trade_date", F.lit(name).alias("model"), "label", "prediction")
        out = p if out is None else out.unionByName(p)
    return out


@register("reg_metrics", with_ctes("""SELECT round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2,
  round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
  round(avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END), 6) AS mape
FROM (SELECT lead(close) OVER (PARTITION BY stock_code ORDER BY trade_date) AS y, close AS p FROM b) WHERE y IS NOT NULL""",
                                   b=V_BARS_SQL))
def reg_metrics(spark, sf_dir):
    """R2, RMSE, MAE, MAPE of the fixed naive forecast (next close =
    today's close) on every bar."""
    from ..functions.ordered import ordered_window_apply
    b = ordered_window_apply(v_bars(spark, sf_dir), ["trade_date"], ["stock_code"],
                             lambda w: [F.lead("close").over(w).alias("y")], fwd=1)
    p = b.where(F.col("y").isNotNull()).select("y", F.col("close").alias("p"))
    m = mt.regression_metrics(p, "y", "p")
    return m.select(*[F.round(c, 6).alias(c) for c in ["r2", "rmse", "mae", "mape"]])


# -------------------------------------------------------- recommendation
def rating_split(spark, sf_dir):
    """Known and held-out ratings, stored once: several jobs read them."""
    r = md.hash_folds(v_rating(spark, sf_dir).withColumn("_k", F.concat_ws("#", "user_id", "item_id")), "_k", 5)
    r = materialize(r)
    return r.where(F.col("fold") != 0).drop("fold", "_k"), r.where(F.col("fold") == 0).drop("fold", "_k")


@register("rec_als")
def rec_als(spark, sf_dir):
    """ALS (rank 10, 20 iterations, reg 0.1) on the known ratings;
    predictions for the held-out fifth."""
    tr, te = rating_split(spark, sf_dir)
    m = md.als(tr)
    return m.transform(te).select("user_id", "item_id", "rating", "prediction")


@register("rec_metrics")
def rec_metrics(spark, sf_dir):
    """RMSE and MAE of ALS on held-out ratings (D12: not on training)."""
    p = rec_als(spark, sf_dir)
    return mt.regression_metrics(p, "rating", "prediction").select("rmse", "mae")


@register("rec_compare")
def rec_compare(spark, sf_dir):
    """ALS against user-based and item-based CF on the same hold-out,
    ranked by RMSE."""
    from ..operators.recommend import cf_predict_pairs
    tr, te = rating_split(spark, sf_dir)
    rows = []
    p = md.als(tr).transform(te)
    rows.append(mt.regression_metrics(p, "rating", "prediction").withColumn("model", F.lit("als")))
    for kind in ("user", "item"):
        q = cf_predict_pairs(tr, te.select("user_id", "item_id", "rating"), kind=kind)
        rows.append(mt.regression_metrics(q, "rating", "prediction").withColumn("model", F.lit(f"{kind}_cf")))
    out = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return out.select("model", "rmse", "mae").orderBy("rmse")


@register("rec_by_name")
def rec_by_name(spark, sf_dir):
    """Top 10 items per user by the model asked for (here ALS; ``user_cf``
    and ``item_cf`` are ``cf_user_topn`` and ``cf_item_topn``)."""
    r = materialize(v_rating(spark, sf_dir))
    return md.recommend_by_name("als", r, 10)
