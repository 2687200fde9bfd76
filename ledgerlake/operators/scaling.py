"""Normalisation (N1-N6): fit one aggregate, store parameters, apply as a
projection; ``inverse`` reads the same parameters back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import numeric_columns
from ..functions.ordered import quantile_params


def _cols(df: DataFrame, columns) -> list[str]:
    return [c for c in (columns or numeric_columns(df)) if c in df.columns]


def _project(df: DataFrame, exprs: dict) -> DataFrame:
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def fit_minmax(df, columns=None, feature_range=(0.0, 1.0)) -> dict:
    cols = _cols(df, columns)
    row = df.agg(*[x for c in cols for x in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]).first()
    lo, hi = feature_range
    out = {}
    for c in cols:
        mn, mx = row[f"lo_{c}"], row[f"hi_{c}"]
        if mn is None:
            continue
        # A constant column has no stored parameter, it becomes the low end.
        out[c] = ({"method": "minmax", "min": float(mn), "max": float(mx), "feature_range": [lo, hi]}
                  if mx != mn else {"method": "constant", "value": float(lo)})
    return out


def fit_zscore(df, columns=None, with_mean=True, with_std=True) -> dict:
    cols = _cols(df, columns)
    row = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"))]).first()
    out = {}
    for c in cols:
        m, s = row[f"m_{c}"], row[f"s_{c}"]
        if m is None:
            continue
        if s is None or s == 0:
            out[c] = {"method": "constant", "value": 0.0}
        else:
            out[c] = {"method": "zscore", "mean": float(m) if with_mean else 0.0,
                      "std": float(s) if with_std else 1.0}
    return out


def robust_probs(quantile_range=(25.0, 75.0)) -> list[float]:
    return sorted({quantile_range[0] / 100.0, 0.5, quantile_range[1] / 100.0})


def fit_robust(df, columns=None, quantile_range=(25.0, 75.0), known: dict | None = None) -> dict:
    """``known``: the quantiles of some columns of ``df``, found before."""
    cols = _cols(df, columns)
    lo, hi = quantile_range[0] / 100.0, quantile_range[1] / 100.0
    q = {c: known[c] for c in cols if c in known} if known else {}
    rest = [c for c in cols if c not in q]
    if rest:
        q.update(quantile_params(df, rest, robust_probs(quantile_range)))
    out = {}
    for c in cols:
        if not q[c]:
            continue
        iqr = q[c][hi] - q[c][lo]
        out[c] = ({"method": "constant", "value": 0.0} if iqr == 0 else
                  {"method": "robust", "median": q[c][0.5], "iqr": iqr, "quantile_range": list(quantile_range)})
    return out


def fit_log(df, columns=None, base="e", offset=1.0) -> dict:
    """A column with negatives adds |min| to the offset, and the grown
    offset carries over to the columns after it (D8, kept)."""
    if base not in ("e", "10", "2"):
        raise ValueError(f"unknown log base {base!r}")
    cols = _cols(df, columns)
    row = df.agg(*[F.min(c).alias(c) for c in cols]).first()
    out = {}
    for c in cols:
        mn = row[c]
        if mn is not None and mn < 0:
            offset = abs(mn) + offset
        out[c] = {"method": "log", "base": base, "offset": float(offset)}
    return out


def transform(df: DataFrame, params: dict) -> DataFrame:
    exprs = {}
    for c, p in params.items():
        if c not in df.columns:
            continue
        x = F.col(c).cast("double")
        m = p["method"]
        if m == "constant":
            exprs[c] = F.lit(p["value"]).cast("double")
        elif m == "minmax":
            lo, hi = p["feature_range"]
            exprs[c] = (x - p["min"]) / (p["max"] - p["min"]) * (hi - lo) + lo
        elif m == "zscore":
            exprs[c] = (x - p["mean"]) / p["std"]
        elif m == "robust":
            exprs[c] = (x - p["median"]) / p["iqr"]
        elif m == "log":
            v = x + p["offset"]
            exprs[c] = {"e": F.ln(v), "10": F.log10(v), "2": F.log2(v)}[p["base"]]
    return _project(df, exprs)


def inverse_transform(df: DataFrame, params: dict, columns=None) -> DataFrame:
    """Undo N1-N4; columns without parameters (constants) stay as they are."""
    exprs = {}
    for c, p in params.items():
        if c not in df.columns or (columns and c not in columns):
            continue
        x = F.col(c).cast("double")
        m = p["method"]
        if m == "minmax":
            lo, hi = p["feature_range"]
            exprs[c] = (x - lo) / (hi - lo) * (p["max"] - p["min"]) + p["min"]
        elif m == "zscore":
            exprs[c] = x * p["std"] + p["mean"]
        elif m == "robust":
            exprs[c] = x * p["iqr"] + p["median"]
        elif m == "log":
            base = {"e": F.exp(x), "10": F.pow(F.lit(10.0), x), "2": F.pow(F.lit(2.0), x)}[p["base"]]
            exprs[c] = base - p["offset"]
    return _project(df, exprs)


FITTERS = {"minmax": fit_minmax, "zscore": fit_zscore, "robust": fit_robust, "log": fit_log}


def scale(df: DataFrame, method: str = "robust", columns=None, **kw) -> tuple[DataFrame, dict]:
    if method not in FITTERS:
        raise ValueError(f"unknown normalisation {method!r}")
    p = FITTERS[method](df, columns, **kw)
    return transform(df, p), p


# ------------------------------------------------------------------ N6
def params_frame(spark: SparkSession, params: dict) -> DataFrame:
    """Parameters as a small DataFrame: (column, method, params_json)."""
    rows = [(c, p["method"], json.dumps(p, sort_keys=True)) for c, p in params.items()]
    return spark.createDataFrame(rows, "column string, method string, params_json string")


def save_params(spark: SparkSession, params: dict, path: str) -> None:
    params_frame(spark, params).coalesce(1).write.mode("overwrite").json(path)


def load_params(spark: SparkSession, path: str) -> dict:
    rows = spark.read.schema("column string, method string, params_json string").json(path).collect()
    return {r["column"]: json.loads(r["params_json"]) for r in rows}
