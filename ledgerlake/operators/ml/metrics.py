"""Model metrics as plain aggregates.

Every metric is one or two aggregate jobs over (label, prediction[, score])
or (cluster, vector) rows, so the same numbers come out of a DuckDB query
over the same rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.ordered import materialize, prefix_sum


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Counts by (actual, predicted)."""
    return df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class precision, recall, F1, support and miss
    rate FN / (FN + TP); zero division gives 0 (sklearn's default)."""
    c = confusion(df, label, pred)
    classes = c.select(F.col("actual").alias("cls")).union(c.select(F.col("predicted").alias("cls"))).distinct()
    tp = c.where(F.col("actual") == F.col("predicted")).select(F.col("actual").alias("cls"), F.col("n").alias("tp"))
    sup = c.groupBy(F.col("actual").alias("cls")).agg(F.sum("n").alias("support"))
    prd = c.groupBy(F.col("predicted").alias("cls")).agg(F.sum("n").alias("predicted_n"))
    r = classes.join(tp, "cls", "left").join(sup, "cls", "left").join(prd, "cls", "left").na.fill(0)
    prec = F.when(F.col("predicted_n") > 0, F.col("tp") / F.col("predicted_n")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    r = r.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    miss = F.when(F.col("support") > 0, (F.col("support") - F.col("tp")) / F.col("support")).otherwise(0.0)
    return r.select("cls", "support", "tp", "predicted_n", "precision", "recall", f1.alias("f1"),
                    miss.alias("miss_rate"))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction",
                           score: str | None = None) -> DataFrame:
    """Accuracy, support-weighted precision / recall / F1 and (binary,
    with a score column) ROC AUC - one row."""
    rep = class_report(df, label, pred)
    n = F.sum("support")
    out = rep.agg((F.sum("tp") / n).alias("accuracy"),
                  (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                  (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
                  (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"))
    if score is not None:
        auc = roc_auc(df, label, score).first()["auc"]
        out = out.withColumn("auc", F.lit(auc))
    return out


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Binary ROC AUC by the rank-sum rule (ties get half credit), computed
    from per-score counts: no per-row window over the whole table."""
    g = df.groupBy(F.col(score).alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"))
    # negatives strictly below each score: a distributed running sum over
    # the distinct scores (no single-task window)
    g = prefix_sum(g, "neg", ["s"], "neg_below", inclusive=False)
    tot = g.agg(F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("u"),
                F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    return tot.select((F.col("u") / (F.col("p") * F.col("q"))).alias("auc"))


def roc_auc_ovr(df: DataFrame, label: str, scores: dict) -> float:
    """C7 for several classes: mean over the classes of the one-vs-rest AUC;
    ``scores`` maps a class to the column of its score (a few classes)."""
    found = [roc_auc(df.select((F.col(label) == F.lit(c)).cast("int").alias("y"), F.col(s).alias("s")), "y", "s").first()["auc"]
             for c, s in scores.items()]
    return float(sum(found) / len(found))


def regression_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """R2, RMSE, MAE, MAPE (fraction; rows with a zero label skipped)."""
    e = F.col(label) - F.col(pred)
    agg = df.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                 F.avg(F.when(F.col(label) != 0, F.abs(e / F.col(label)))).alias("mape"),
                 F.var_pop(label).alias("var_y"))
    return agg.select((1 - F.col("mse") / F.col("var_y")).alias("r2"), F.sqrt("mse").alias("rmse"), "mae", "mape")


# Clusters whose centroids every task may hold.
_BROADCAST_CLUSTERS = 4096


def _vec(col: str):
    return F.col(col).cast("array<double>")


def _dist2(a, b):
    """Squared distance of two arrays, summed coordinate by coordinate."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, v: t + v)


def _centroids(df: DataFrame, cluster: str, vec: str, dim: int) -> DataFrame:
    """(cluster, n, m): count and mean of every cluster, stored; a clustering may
    have as many of them as it has rows."""
    x = array_to_vector(F.slice(_vec(vec), 1, dim))
    rows = df.select(cluster, x.alias("x"))
    return materialize(rows.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.mean(F.col("x"))).alias("m")))


def _with_centroid(df: DataFrame, cluster: str, vec: str, centroids: DataFrame, k: int) -> DataFrame:
    """(cluster, d2): squared distance of every row to the centroid of its cluster."""
    c = centroids.select(cluster, "m")
    both = df.select(cluster, _vec(vec).alias("x")).join(F.broadcast(c) if k <= _BROADCAST_CLUSTERS else c, cluster)
    return both.select(cluster, _dist2(F.col("x"), F.col("m")).alias("d2"))


def calinski_harabasz(df: DataFrame, cluster: str, vec: str, dim: int) -> DataFrame:
    """Between / within dispersion ratio.  Centroids are a table joined to
    the rows, the within part is one aggregate over them."""
    cen = _centroids(df, cluster, vec, dim)
    weight = F.col("n").cast("double")
    k, n, g = cen.agg(F.count(F.lit(1)), F.sum("n"), Summarizer.mean(array_to_vector("m"), weight)).first()
    b = cen.agg(F.sum(F.col("n") * _dist2(F.col("m"), F.array(*[F.lit(float(v)) for v in g])))).first()[0]
    within = _with_centroid(df, cluster, vec, cen, k).agg(F.sum("d2").alias("w"))
    return within.select((F.lit(b / (k - 1)) / (F.col("w") / F.lit(n - k))).alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, cluster: str, vec: str, dim: int) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij; scatter s_i is
    one aggregate over the rows, pairs of clusters meet in blocks."""
    from .blocks import block_pairs, exact_slices
    cen = _centroids(df, cluster, vec, dim)
    k = cen.count()
    scatter = _with_centroid(df, cluster, vec, cen, k).groupBy(cluster).agg(F.avg(F.sqrt("d2")).alias("s"))
    points = materialize(cen.join(scatter, cluster).select(F.col(cluster).alias("id"), F.col("m").alias("x"), "s"))

    def worst(a, b, x, y, same):
        sa, sb = a["s"].to_numpy(), b["s"].to_numpy()
        rows, columns = np.full(len(a), -np.inf), np.full(len(b), -np.inf)
        for lo, d2 in exact_slices(x, y):
            with np.errstate(divide="ignore"):
                ratio = (sa[lo:lo + len(d2), None] + sb[None, :]) / np.sqrt(d2)
            if same:
                ratio[np.arange(len(d2)), lo + np.arange(len(d2))] = -np.inf
            rows[lo:lo + len(d2)] = ratio.max(axis=1)
            columns = np.maximum(columns, ratio.max(axis=0))
        out = [pd.DataFrame({"id": a["id"], "r": rows})]
        if not same:
            out.append(pd.DataFrame({"id": b["id"], "r": columns}))
        return pd.concat(out)

    found = block_pairs(points, worst, f"id {dict(points.dtypes)['id']}, r double")
    return found.groupBy("id").agg(F.max("r").alias("r")).agg(F.avg("r").alias("davies_bouldin"))


def silhouette(df: DataFrame, key: str, cluster: str, vec: str) -> DataFrame:
    """Mean Euclidean silhouette of all points, each against all others.

    Pairs of point blocks return, per point and cluster, the sum of distances
    and the number of points: rows grow with points x clusters x blocks, the
    n x n distances stay inside the tasks."""
    from .blocks import block_pairs, exact_slices
    pts = df.select(F.col(key).alias("id"), F.transform(F.col(vec), lambda v: v.cast("double")).alias("x"), F.col(cluster).alias("c"))
    kinds = dict(pts.dtypes)

    def sums(a, b, x, y, same):
        orders = [np.argsort(f["c"].to_numpy(), kind="stable") for f in (a, b)]
        a, b = (f.iloc[o].reset_index(drop=True) for f, o in zip((a, b), orders))
        x, y = x[orders[0]], y[orders[1]]
        (ca, fa, na), (cb, fb, nb) = (np.unique(f["c"].to_numpy(), return_index=True, return_counts=True) for f in (a, b))
        row_sums, column_sums = np.zeros((len(a), len(cb))), np.zeros((len(ca), len(b)))
        own = a[["id"]].reset_index(names="r").merge(b[["id"]].reset_index(names="s"), on="id")      # a point and itself
        r0, c0 = own["r"].to_numpy(), own["s"].to_numpy()
        for lo, d2 in exact_slices(x, y):
            hi = lo + len(d2)
            mine = (r0 >= lo) & (r0 < hi)
            d2[r0[mine] - lo, c0[mine]] = 0.0
            d = np.sqrt(d2, out=d2)
            row_sums[lo:hi] = np.add.reduceat(d, fb, axis=1)
            if not same:
                k0, k1 = np.searchsorted(fa, lo, side="right") - 1, np.searchsorted(fa, hi)
                column_sums[k0:k1] += np.add.reduceat(d, np.maximum(fa[k0:k1] - lo, 0), axis=0)

        def told(f, values, classes, counts, at, met):
            n = np.tile(counts, (len(f), 1))
            np.subtract.at(n, (at, met), 1)
            k = len(classes)
            return pd.DataFrame({"id": np.repeat(f["id"].to_numpy(), k), "own": np.repeat(f["c"].to_numpy(), k),
                                 "c": np.tile(classes, len(f)), "s": values.ravel(), "n": n.ravel()})

        out = [told(a, row_sums, cb, nb, r0, np.searchsorted(fb, c0, side="right") - 1)]
        if not same:
            out.append(told(b, column_sums.T, ca, na, c0, np.searchsorted(fa, r0, side="right") - 1))
        return pd.concat(out)

    per = block_pairs(pts, sums, f"id {kinds['id']}, own {kinds['c']}, c {kinds['c']}, s double, n long")
    per = per.groupBy("id", "own", "c").agg((F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).alias("md"))
    ab = per.groupBy("id").agg(F.max(F.when(F.col("c") == F.col("own"), F.col("md"))).alias("a"),
                               F.min(F.when(F.col("c") != F.col("own"), F.col("md"))).alias("b"))
    sil = F.when(F.col("a").isNull(), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return ab.agg(F.avg(sil).alias("silhouette"), F.count(F.lit(1)).alias("points"))
