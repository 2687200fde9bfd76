"""Preprocessing pipeline (P1-P3): missing -> outliers -> scaling ->
features.  Each step's fit is one or two aggregate jobs; the data itself only
flows once, through one lazy projection chain, when the caller acts on it.
Row counts per step come from ``DataFrame.observe``, so the report adds no
jobs of its own."""

from __future__ import annotations

import copy
import json
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import features as fe
from . import missing as mv
from . import outliers as ol
from . import scaling as sc

# The default configuration is the contract.
DEFAULT_CONFIG = {
    "missing_value": {"enabled": True, "strategy": "auto", "numeric_strategy": "median",
                      "categorical_strategy": "mode", "drop_threshold": 0.8},
    "outlier": {"enabled": True, "method": "iqr", "action": "clip", "factor": 1.5, "columns": None,
                "threshold": None},
    "normalization": {"enabled": True, "method": "robust", "columns": None},
    "feature_engineering": {"enabled": True, "time_features": None, "lag_features": None,
                            "rolling_features": None, "encode_columns": None, "encode_method": "label"},
}
MISSING_STRATEGIES = {"auto", "mean", "median", "mode", "ffill", "interpolate", "constant", "drop"}
OUTLIER_ACTIONS = {"clip", "remove", "detect_only"}
ENCODE_METHODS = {"label", "onehot"}


def merge_config(user: dict | None) -> dict:
    """Two-level merge over the defaults, validated up front (D11:
    unknown names fail when the job is built, not silently later)."""
    cfg = copy.deepcopy(DEFAULT_CONFIG)
    for section, vals in (user or {}).items():
        if section not in cfg:
            raise ValueError(f"unknown config section {section!r}")
        if isinstance(vals, dict):
            cfg[section].update(vals)
        else:
            cfg[section] = vals
    mvc, oc, nc = cfg["missing_value"], cfg["outlier"], cfg["normalization"]
    if mvc["strategy"] not in MISSING_STRATEGIES:
        raise ValueError(f"unknown missing strategy {mvc['strategy']!r}")
    if oc["method"] not in ("iqr", "zscore", "quantile") or oc["action"] not in OUTLIER_ACTIONS:
        raise ValueError(f"unknown outlier method/action {oc['method']!r}/{oc['action']!r}")
    if oc["action"] == "clip" and oc["method"] == "zscore":
        raise ValueError("action 'clip' takes method 'iqr' or 'quantile'")
    if oc["action"] != "clip" and oc["method"] == "quantile":
        raise ValueError(f"action {oc['action']!r} takes method 'iqr' or 'zscore'")
    if nc["method"] not in sc.FITTERS:
        raise ValueError(f"unknown normalisation {nc['method']!r}")
    fc = cfg["feature_engineering"]
    if fc["encode_method"] not in ENCODE_METHODS:
        raise ValueError(f"unknown encode_method {fc['encode_method']!r}")
    if isinstance(fc["time_features"], dict):
        if "column" not in fc["time_features"]:
            raise ValueError("time_features needs a column")
        odd = set(fc["time_features"].get("features") or ()) - set(fe.TIME_FEATURES)
        if odd:
            raise ValueError(f"unknown time features {sorted(odd)}")
    odd = set((fc["rolling_features"] or {}).get("stats", ())) - set(fe.ROLL_STATS)
    if odd:
        raise ValueError(f"unknown rolling statistics {sorted(odd)}")
    return cfg


def load_config(spark: SparkSession, path: str) -> dict:
    """A configuration saved as JSON, merged over the defaults."""
    text = "".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect())   # one small file
    return merge_config(json.loads(text))


def save_config(spark: SparkSession, cfg: dict, path: str) -> None:
    text = json.dumps(cfg, indent=2, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


class PreprocessingPipeline:
    """P1.  ``order`` is the unique row order used by order-dependent steps;
    ``exclude`` keeps ids and labels out of clipping and scaling (D7: the
    reference default touches every numeric column, which is ``exclude=()``)."""

    def __init__(self, config: dict | None = None, order: Sequence[str] = (), exclude: Sequence[str] = ()):
        self.config = merge_config(config)
        self.order = list(order)
        self.exclude = list(exclude)
        self.steps: list[dict] = []
        self.params: dict = {}
        self._last: DataFrame | None = None

    def _log(self, name: str, df: DataFrame, t0: float, details: dict) -> DataFrame:
        obs = Observation(f"step_{len(self.steps)}_{name}_{id(self)}")
        out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        self.steps.append({"step": name, "columns": len(df.columns), "fit_sec": round(time.time() - t0, 4),
                           "details": details, "obs": obs})
        return out

    def _numeric(self, df: DataFrame, cols) -> list[str]:
        base = cols or fe.numeric_columns(df)
        return [c for c in base if c in df.columns and c not in self.exclude]

    def run(self, df: DataFrame) -> DataFrame:
        cfg = self.config
        self.steps = []
        df = self._log("input", df, time.time(), {})
        m = cfg["missing_value"]
        if m["enabled"]:
            t0 = time.time()
            s = m["strategy"]
            if s == "auto":
                df, p = mv.auto_fill(df, self.order, m["numeric_strategy"], m["categorical_strategy"],
                                     m["drop_threshold"])
            elif s == "mean":
                df, p = mv.fill_mean(df)
            elif s == "median":
                df, p = mv.fill_median(df)
            elif s == "mode":
                df, p = mv.fill_mode(df)
            elif s == "ffill":
                df, p = mv.fill_forward(df, self.order), {}
            elif s == "interpolate":
                df, p = mv.fill_interpolate(df, self.order), {}
            elif s == "constant":
                df, p = mv.fill_constant(df, fill_value=m.get("fill_value", 0)), {}
            else:
                before = df.columns
                df = mv.drop_sparse_columns(df, m["drop_threshold"])
                p = {"dropped": [c for c in before if c not in df.columns]}
            self.params["missing_value"] = p
            df = self._log("missing_value", df, t0, {"strategy": s})
        o, n, known = cfg["outlier"], cfg["normalization"], {}
        robust = n["enabled"] and n["method"] == "robust"
        if o["enabled"]:
            t0 = time.time()
            cols = self._numeric(df, o["columns"])
            if o["action"] == "clip":
                probs = sc.robust_probs(n.get("quantile_range", (25.0, 75.0))) if robust else []
                df, b, known = ol.clip_and_quantiles(df, cols, o["method"], o["factor"], probs)
                self.params["outlier"] = b
            elif o["action"] == "remove":
                df = ol.remove_outliers(df, cols, o["method"], o["factor"], o.get("threshold"))
            else:
                self.params["outlier"] = ol.outlier_counts(df, cols, o["method"], o["factor"], o.get("threshold"))
            df = self._log("outlier", df, t0, {"method": o["method"], "action": o["action"]})
        if n["enabled"]:
            t0 = time.time()
            cols = self._numeric(df, n["columns"])
            kw = {k: v for k, v in n.items() if k not in ("enabled", "method", "columns")}
            if robust:
                kw["known"] = known
            df, p = sc.scale(df, n["method"], cols, **kw)
            self.params["normalization"] = p
            df = self._log("normalization", df, t0, {"method": n["method"]})
        f = cfg["feature_engineering"]
        if f["enabled"]:
            t0 = time.time()
            if f.get("time_features"):
                tf = f["time_features"]
                tf = tf if isinstance(tf, dict) else {"column": tf}
                df = fe.extract_time_features(df, tf["column"], tf.get("features"))
            if f.get("lag_features"):
                lf = f["lag_features"]
                df = fe.create_lag_features(df, lf["columns"], lf.get("lags", [1, 5, 10]), self.order,
                                            lf.get("group_col"))
            if f.get("rolling_features"):
                rf = f["rolling_features"]
                df = fe.create_rolling_features(df, rf["columns"], self.order, rf.get("windows", [5, 10, 20]),
                                                rf.get("stats", ["mean", "std"]), rf.get("group_col"))
            if f.get("encode_columns"):
                if f["encode_method"] == "onehot":
                    df = fe.onehot_encode(df, f["encode_columns"])
                else:
                    df, _ = fe.label_encode(df, f["encode_columns"], self.order)
            df = self._log("feature_engineering", df, t0, {})
        self._last = df
        return df

    def report(self, spark: SparkSession, materialize: bool = True) -> DataFrame:
        """One row per step - rows, columns, fit time, details.  Row counts
        are the observed metrics; with ``materialize`` the output is run once
        through the no-op sink (skip it when the caller already wrote it)."""
        if materialize and self._last is not None:
            self._last.write.format("noop").mode("overwrite").save()
        rows = []
        for i, s in enumerate(self.steps):
            metrics = s["obs"].get
            rows.append((i, s["step"], int(metrics["rows"]), s["columns"], float(s["fit_sec"]),
                         json.dumps(s["details"], sort_keys=True)))
        return spark.createDataFrame(rows, "step_no int, step string, rows long, columns int, fit_sec double, "
                                           "details string")
