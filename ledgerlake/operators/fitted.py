"""Fits that extend to new data (M, O, N with N6; D15).

What a fit needs of a column is kept as a row: count, nulls, least and greatest
value, mean, sum of squared deviations, and a KLL quantile sketch.  Rows of
several parts merge by Chan's rule and by merging the sketches, so new data
extend a stored fit without the old data being read.  Moments of merged parts
are those of the whole; quantiles are within the sketch's rank error (about
2.3 / k at 99 %), and exact while a column has at most ``k`` values.

Nulls and NaN count as missing; a column without values has null statistics and
no parameters."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import numeric_columns
from ..functions.ordered import sketch_quantiles
from . import scaling

K = 2000
STATE = ("column string, n long, nulls long, lo double, hi double, mean double, m2 double, sketch binary")


def fit_state(df: DataFrame, columns: Sequence[str] | None = None, k: int = K) -> DataFrame:
    """A row per column: one aggregate over ``df``."""
    columns = [c for c in (columns or numeric_columns(df)) if c in df.columns]
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count(x).alias("n"), F.count(F.when(x.isNull(), 1)).alias("nulls"), F.min(x).alias("lo"),
            F.max(x).alias("hi"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"),
            F.kll_sketch_agg_double(x, k).alias("sketch")).alias(f"s{i}"))
    if not aggs:
        return df.sparkSession.createDataFrame([], STATE)
    rows = df.agg(*aggs)
    return rows.select(F.inline(F.array(*[f"s{i}" for i in range(len(columns))])))


def merge_states(*states: DataFrame) -> DataFrame:
    """One row per column of all parts together."""
    rows = states[0]
    for s in states[1:]:
        rows = rows.unionByName(s)
    # A few rows per column; the deviations are taken from the common mean.
    total = rows.groupBy("column").agg(F.sum("n").alias("all_n"), F.sum(F.col("mean") * F.col("n")).alias("all_sum"))
    both = rows.join(total, "column")
    mean = F.col("all_sum") / F.nullif("all_n", F.lit(0))
    apart = F.col("m2") + F.col("n") * (F.col("mean") - mean) * (F.col("mean") - mean)
    return both.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.max(mean).alias("mean"), F.sum(apart).alias("m2"), F.kll_merge_agg_double("sketch").alias("sketch"))


def save_state(state: DataFrame, path: str) -> None:
    """Add the rows to the stored parts at ``path``."""
    state.write.mode("append").parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The stored parts merged."""
    return merge_states(spark.read.schema(STATE).parquet(path))


def _quantiles(spark: SparkSession, rows: Sequence, probs: Sequence[float]) -> list[list[float]]:
    """Per row of a state the values at ranks ``p * (n - 1)``, interpolated like
    exact quantiles."""
    asked, out = [], []
    for r in rows:
        at = [p * (r["n"] - 1) for p in probs]
        asked.append((r["sketch"], [min(1.0, (f(x) + 1) / r["n"]) for x in at for f in (math.floor, math.ceil)]))
    found = sketch_quantiles(spark, asked) if probs else [[]] * len(asked)
    for r, q in zip(rows, found):
        out.append([q[2 * i] + (p * (r["n"] - 1) - math.floor(p * (r["n"] - 1))) * (q[2 * i + 1] - q[2 * i]) for i, p in enumerate(probs)])
    return out


def statistics(state: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, n, nulls, lo, hi, mean, std, q_<percent> ...), a row per column;
    the deviation is the sample's."""
    rows = state.collect()
    known = [r for r in rows if r["n"]]
    found = dict(zip([r["column"] for r in known], _quantiles(state.sparkSession, known, probs)))
    out = [(r["column"], r["n"], r["nulls"], r["lo"], r["hi"], r["mean"], math.sqrt(r["m2"] / (r["n"] - 1)) if r["n"] > 1 else None,
            *found.get(r["column"], [None] * len(probs))) for r in rows]
    names = "".join(f", q_{round(p * 100)} double" for p in probs)
    return state.sparkSession.createDataFrame(out, "column string, n long, nulls long, lo double, hi double, mean double, std double" + names)


def scaler_params(state: DataFrame, method: str = "robust", feature_range=(0.0, 1.0), quantile_range=(25.0, 75.0)) -> dict:
    """Parameters of :func:`scaling.transform` from a fit (a row per column)."""
    lo_p, hi_p = quantile_range[0] / 100.0, quantile_range[1] / 100.0
    if method not in ("minmax", "zscore", "robust"):
        raise ValueError(f"unknown method {method!r}")
    probs = [lo_p, 0.5, hi_p] if method == "robust" else []
    out = {}
    for r in statistics(state, probs).collect():
        if not r["n"]:
            continue
        if method == "minmax":
            p = {"method": "minmax", "min": r["lo"], "max": r["hi"], "feature_range": list(feature_range)}
            p = p if r["hi"] != r["lo"] else {"method": "constant", "value": float(feature_range[0])}
        elif method == "zscore":
            p = {"method": "zscore", "mean": r["mean"], "std": r["std"]} if r["std"] else {"method": "constant", "value": 0.0}
        else:
            q1, median, q3 = (r[f"q_{round(p * 100)}"] for p in probs)
            p = {"method": "robust", "median": median, "iqr": q3 - q1, "quantile_range": list(quantile_range)}
            p = p if q3 != q1 else {"method": "constant", "value": 0.0}
        out[r["column"]] = p
    return out


def exact_params(df: DataFrame, columns: Sequence[str], method: str = "robust") -> dict:
    """The exact option: parameters from the data themselves."""
    return scaling.FITTERS[method](df, columns)


def outlier_bounds(state: DataFrame, factor: float = 1.5) -> dict[str, tuple[float, float]]:
    """IQR fences per column from a fit."""
    return {r["column"]: (r["q_25"] - factor * (r["q_75"] - r["q_25"]), r["q_75"] + factor * (r["q_75"] - r["q_25"]))
            for r in statistics(state).collect() if r["n"]}


def fill_values(state: DataFrame, how: str = "mean") -> dict[str, float]:
    """Values to fill missing ones with, per column."""
    column = {"mean": "mean", "median": "q_50", "min": "lo", "max": "hi"}[how]
    return {r["column"]: r[column] for r in statistics(state).collect() if r["n"] and not math.isnan(r[column])}
