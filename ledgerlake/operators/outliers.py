"""Outlier operators (O1-O8).  Bounds are fitted in one distributed quantile
job and applied as column expressions; null cells are never outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import clip, numeric_columns
from ..functions.ordered import between, quantile_neighbours, quantile_params


def _cols(df: DataFrame, columns) -> list[str]:
    return [c for c in (columns or numeric_columns(df)) if c in df.columns]


def iqr_bounds(df: DataFrame, columns=None, factor: float = 1.5) -> dict[str, dict]:
    """Q1, Q3, IQR and the fences per column (exact quantiles)."""
    cols = _cols(df, columns)
    return _fences(quantile_params(df, cols, [0.25, 0.75]), cols, factor)


def _fences(q: dict[str, dict[float, float]], cols: Sequence[str], factor: float) -> dict[str, dict]:
    out = {}
    for c in cols:
        q1, q3 = q[c].get(0.25), q[c].get(0.75)
        if q1 is None:
            continue
        iqr = q3 - q1
        out[c] = {"q1": q1, "q3": q3, "iqr": iqr, "lower": q1 - factor * iqr, "upper": q3 + factor * iqr}
    return out


def outside(c: str, lo, hi) -> Column:
    """Mask cell: strictly outside [lo, hi]; null is not an outlier."""
    return F.coalesce((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)), F.lit(False))


def iqr_report(df: DataFrame, columns=None, factor: float = 1.5) -> DataFrame:
    """O1 + O8: one row per column with the IQR statistics, outlier count and
    percent of all rows.  Bounds come from the fit job; the counts are one
    more aggregate over the data, and the report is unpivoted lazily."""
    b = iqr_bounds(df, columns, factor)
    cols = list(b)
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.sum(outside(c, b[c]["lower"], b[c]["upper"]).cast("long")).alias(c)
                                                for c in cols]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.lit(b[c]["q1"]).alias("q1"), F.lit(b[c]["q3"]).alias("q3"),
        F.lit(b[c]["iqr"]).alias("iqr"), F.lit(b[c]["lower"]).alias("lower_bound"),
        F.lit(b[c]["upper"]).alias("upper_bound"), F.col(c).alias("outlier_count")) for c in cols])).alias("s")
    out = one.select("__n", rows).select("s.*", "__n")
    return out.withColumn("outlier_pct", F.round(F.col("outlier_count") * 100.0 / F.col("__n"), 2)).drop("__n")


def iqr_mask(df: DataFrame, keys: Sequence[str], columns=None, factor: float = 1.5) -> DataFrame:
    """O2: boolean outlier flag per cell, keyed rows."""
    b = iqr_bounds(df, columns, factor)
    return df.select(*keys, *[outside(c, v["lower"], v["upper"]).alias(c) for c, v in b.items()])


def zscore_params(df: DataFrame, columns=None) -> dict[str, dict]:
    cols = _cols(df, columns)
    row = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"))]).first()
    return {c: {"mean": row[f"m_{c}"], "std": row[f"s_{c}"]} for c in cols}


def zscore_mask(df: DataFrame, keys: Sequence[str], columns=None, threshold: float = 3.0) -> DataFrame:
    """O3: |x - mean| / sample std above ``threshold``; zero-std (or
    undefined-std) columns are skipped."""
    p = zscore_params(df, columns)
    cols = [c for c, v in p.items() if v["std"] not in (None, 0.0)]
    return df.select(*keys, *[F.coalesce(F.abs(F.col(c) - p[c]["mean"]) / p[c]["std"] > threshold, F.lit(False))
                              .alias(c) for c in cols])


def clip_outliers(df: DataFrame, columns=None, method: str = "iqr", factor: float = 1.5) -> tuple[DataFrame, dict]:
    """Winsorise to the IQR fences or to the 1% / 99% quantiles."""
    return clip_and_quantiles(df, columns, method, factor)[:2]


def clip_and_quantiles(df: DataFrame, columns=None, method: str = "iqr", factor: float = 1.5,
                       probs: Sequence[float] = ()) -> tuple[DataFrame, dict, dict[str, dict[float, float]]]:
    """:func:`clip_outliers`, and the quantiles ``probs`` of the clipped columns
    by the same passes: clipping keeps the order of values, so the values around
    a quantile are the clipped ones around it before.  Columns that may have NaN,
    which clipping makes a value, are not among them."""
    cols = _cols(df, columns)
    if method not in ("iqr", "quantile"):
        raise ValueError(f"unknown clip method {method!r}")
    ends = (0.25, 0.75) if method == "iqr" else (0.01, 0.99)
    around, nans = quantile_neighbours(df, cols, sorted({*ends, *probs}))
    q = {c: {p: between(*v) for p, v in x.items()} for c, x in around.items()}
    if method == "iqr":
        b = {c: (v["lower"], v["upper"]) for c, v in _fences(q, cols, factor).items()}
    else:
        b = {c: (q[c][0.01], q[c][0.99]) for c in cols if q[c]}
    out = df.select(*[clip(F.col(c).cast("double"), *b[c]).alias(c) if c in b else F.col(c)
                      for c in df.columns])

    def clipped(c, p):
        lo, hi, share = around[c][p]
        return between(*(min(max(x, b[c][0]), b[c][1]) for x in (lo, hi)), share)
    return out, b, {c: {p: clipped(c, p) for p in probs} for c in b if c not in nans}


def remove_outliers(df: DataFrame, columns=None, method: str = "iqr", factor: float = 1.5,
                    threshold: float | None = None) -> DataFrame:
    """Drop rows flagged in any column.  ``threshold`` is the z limit for
    ``method='zscore'``; when omitted ``factor`` doubles as the limit, which is
    what the reference pipeline does."""
    cols = _cols(df, columns)
    if method == "iqr":
        b = iqr_bounds(df, cols, factor)
        flags = [outside(c, v["lower"], v["upper"]) for c, v in b.items()]
    elif method == "zscore":
        t = factor if threshold is None else threshold
        p = zscore_params(df, cols)
        flags = [F.coalesce(F.abs(F.col(c) - v["mean"]) / v["std"] > t, F.lit(False))
                 for c, v in p.items() if v["std"] not in (None, 0.0)]
    else:
        raise ValueError(f"unknown method {method!r}")
    if not flags:
        return df
    any_flag = flags[0]
    for f in flags[1:]:
        any_flag = any_flag | f
    return df.where(~any_flag)


def outlier_counts(df: DataFrame, columns=None, method: str = "iqr", factor: float = 1.5,
                   threshold: float | None = None) -> dict[str, int]:
    """Flagged cells per column, leaving the data as it is (``detect_only``)."""
    cols = _cols(df, columns)
    if method == "iqr":
        flags = {c: outside(c, v["lower"], v["upper"]) for c, v in iqr_bounds(df, cols, factor).items()}
    elif method == "zscore":
        t = factor if threshold is None else threshold
        flags = {c: F.coalesce(F.abs(F.col(c) - v["mean"]) / v["std"] > t, F.lit(False))
                 for c, v in zscore_params(df, cols).items() if v["std"] not in (None, 0.0)}
    else:
        raise ValueError(f"unknown method {method!r}")
    if not flags:
        return {}
    row = df.agg(*[F.sum(f.cast("long")).alias(c) for c, f in flags.items()]).first()
    return {c: int(row[c] or 0) for c in flags}
