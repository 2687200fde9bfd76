"""Missing-value operators.

Fit = one aggregate job that returns a small parameter dict; transform = a
lazy projection (``coalesce`` with literals, or a join with a per-group
parameter table).  Row-order fills use the blocked window plan of
``functions.ordered`` instead of a keyless window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import numeric_columns, string_columns
from ..functions.ordered import DEFAULT_BLOCK_ROWS, blocked, carry_fill, exact_quantiles, quantile_params
from .relational import join_groups


def _present(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return [c for c in (cols if cols is not None else df.columns) if c in df.columns]


def nan_as_null(df: DataFrame) -> DataFrame:
    """One missing-value rule for all operators here: NaN in a floating column
    is missing (pandas' model).  A projection, applied at operator entry."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(*[F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c) if c in floats else F.col(c)
                       for c in df.columns])


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> tuple[int, dict[str, int]]:
    """(row count, {column: null count}) in one aggregate job."""
    cols = _present(df, cols)
    aggs = [F.count(F.lit(1)).alias("__n"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols]]
    row = nan_as_null(df).agg(*aggs).first()
    return int(row["__n"]), {c: int(row[c] or 0) for c in cols}


def missing_report(df: DataFrame) -> DataFrame:
    """M1: one row per column that has nulls - null count, percent (2 dp),
    type, non-null count; highest percent first.  One aggregate pass, then an
    unpivot of the one-row result (so the report is computed lazily)."""
    n = F.count(F.lit(1))
    aggs = [n.alias("__n")] + [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns]
    one = nan_as_null(df).agg(*aggs)
    long = one.select("__n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_count"),
                 F.lit(df.schema[c].dataType.simpleString()).alias("dtype")) for c in df.columns])).alias("s"))
    out = long.select("s.column_name", "s.missing_count",
                      F.round(F.col("s.missing_count") * 100.0 / F.col("__n"), 2).alias("missing_pct"),
                      "s.dtype", (F.col("__n") - F.col("s.missing_count")).alias("non_missing"))
    return out.where(F.col("missing_count") > 0).orderBy(F.desc("missing_pct"), "column_name")


# --------------------------------------------------------------- fit helpers
def fit_mean(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    if not cols:
        return {}
    row = nan_as_null(df).agg(*[F.avg(c).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fit_median(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    if not cols:
        return {}
    q = quantile_params(nan_as_null(df), cols, [0.5])
    return {c: q[c].get(0.5) for c in cols}


def mode_table(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per (by..., column), smallest value on ties.

    Two decomposable aggregates - counts per value, then ``min`` of
    (-count, value) - so neither a hot group nor a high-cardinality column is
    ever gathered into one task (``mode()`` would merge a value map)."""
    df = nan_as_null(df)
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    out = None
    for same in by_type.values():  # ties are broken by value, so one unpivot per type
        st = F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).alias("_v")) for c in same])).alias("_s")
        long = df.select(*by, st).select(*by, "_s._c", "_s._v").where(F.col("_v").isNotNull())
        counts = long.groupBy(*by, "_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
        best = counts.groupBy(*by, "_c").agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v"))).alias("_b"))
        one = best.select(*by, F.col("_c").alias("column"), F.col("_b.v").cast("string").alias("mode"))
        out = one if out is None else out.unionByName(one)
    return out


def fit_mode(df: DataFrame, cols: Sequence[str], default: str = "unknown") -> dict[str, str]:
    if not cols:
        return {}
    found = {r["column"]: r["mode"] for r in mode_table(df, cols).collect()}
    return {c: found.get(c, default) for c in cols}


def apply_fill(df: DataFrame, fills: dict) -> DataFrame:
    """Transform: ``coalesce(c, literal)`` per column, one projection."""
    df = nan_as_null(df)
    out = []
    for c in df.columns:
        if c in fills and fills[c] is not None:
            out.append(F.coalesce(F.col(c), F.lit(fills[c]).cast(df.schema[c].dataType)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _cols_with_nulls(df: DataFrame, cols: Sequence[str] | None, kind: str = "any") -> list[str]:
    cand = _present(df, cols)
    if kind == "numeric":
        cand = [c for c in cand if c in numeric_columns(df)]
    elif kind == "text":
        cand = [c for c in cand if c in string_columns(df)]
    if cols is not None:
        return cand
    _, nulls = null_counts(df, cand)
    return [c for c in cand if nulls[c] > 0]


# ---------------------------------------------------------------- operators
def fill_constant(df: DataFrame, columns=None, fill_value=0) -> DataFrame:
    """M2: fill listed columns (default: every column with nulls)."""
    cols = _cols_with_nulls(df, columns)
    return apply_fill(df, {c: fill_value for c in cols})


def fill_mean(df: DataFrame, columns=None) -> tuple[DataFrame, dict]:
    """M3: numeric columns with nulls get the column mean."""
    cols = _cols_with_nulls(df, columns, "numeric")
    p = fit_mean(df, cols)
    return apply_fill(df, p), p


def fill_median(df: DataFrame, columns=None) -> tuple[DataFrame, dict]:
    """M4: exact interpolated median (distributed rank selection)."""
    cols = _cols_with_nulls(df, columns, "numeric")
    p = fit_median(df, cols)
    return apply_fill(df, p), p


def fill_mode(df: DataFrame, columns=None) -> tuple[DataFrame, dict]:
    """M5: text columns get the smallest most-frequent value, or 'unknown'."""
    cols = _cols_with_nulls(df, columns, "text")
    p = fit_mode(df, cols)
    return apply_fill(df, p), p


def fill_group(df: DataFrame, group_col: str, fill_method: str = "mean", columns=None) -> DataFrame:
    """M8: fill with the group's mean / median / mode.  The per-group table
    (one row per group) is left-joined back without bringing a group's rows
    together; a null group key never matches, so such rows stay null, as does
    an all-null group."""
    if columns is None:
        columns = [c for c in (numeric_columns(df) if fill_method != "mode" else df.columns) if c != group_col]
    cols = [c for c in columns if c in df.columns and c != group_col]
    if fill_method == "mean":
        stats = df.groupBy(group_col).agg(*[F.avg(c).alias(f"_g_{c}") for c in cols])
    elif fill_method == "median":
        q = exact_quantiles(df.where(F.col(group_col).isNotNull()), cols, [0.5], by=[group_col])
        stats = q.groupBy(group_col).pivot("column", cols).agg(F.first("value"))
        stats = stats.select(group_col, *[F.col(c).alias(f"_g_{c}") for c in cols])
    elif fill_method == "mode":
        m = mode_table(df.where(F.col(group_col).isNotNull()), cols, by=[group_col])
        stats = m.groupBy(group_col).pivot("column", cols).agg(F.first("mode"))
        stats = stats.select(group_col, *[F.col(c).alias(f"_g_{c}") for c in cols])
    else:
        raise ValueError(f"unknown fill_method {fill_method!r}")
    sizes = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("_rows"))
    j = join_groups(df, sizes.join(stats, group_col, "left"), group_col)
    out = [F.coalesce(F.col(c), F.col(f"_g_{c}").cast(df.schema[c].dataType)).alias(c) if c in cols else F.col(c)
           for c in df.columns]
    return j.select(*out)


def null_ratios(df: DataFrame, cols=None) -> dict[str, float]:
    n, nulls = null_counts(df, cols)
    return {c: (v / n if n else 0.0) for c, v in nulls.items()}


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """M9: drop columns whose null ratio is strictly above ``threshold``."""
    r = null_ratios(df)
    return df.select(*[c for c in df.columns if r[c] <= threshold])


def drop_sparse_rows(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Keep rows whose share of null cells is at most ``threshold``."""
    df = nan_as_null(df)
    k = len(df.columns)
    nulls = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    return df.where(nulls / F.lit(k) <= F.lit(threshold))


def fill_forward(df: DataFrame, order: Sequence[str], columns=None, keys: Sequence[str] = (),
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """M6: forward fill ``columns`` in row order, then backward fill every
    column (the pandas ``ffill().bfill()`` pair).  ``order`` must be unique."""
    df = nan_as_null(df)
    cols = _present(df, columns)
    all_cols = [c for c in df.columns if c not in order and c not in keys]
    bl = blocked(df, order, keys, block_rows).drop("_halo")
    ff = carry_fill(bl, cols, keys, forward=True)
    bf = carry_fill(ff, all_cols, keys, forward=False)
    return bf.select(*df.columns)


def fill_interpolate(df: DataFrame, order: Sequence[str], columns=None, keys: Sequence[str] = (),
                     block_rows: int = DEFAULT_BLOCK_ROWS, method: str = "linear") -> DataFrame:
    """M7: interpolation by row position.  ``linear``: leading nulls stay null,
    trailing nulls take the last value (pandas' forward direction);
    ``nearest`` (the earlier value half way) and ``zero`` (the earlier value) fill
    between values only, as pandas does; ``pad`` / ``bfill`` carry values on."""
    if method not in ("linear", "nearest", "zero", "pad", "bfill"):
        raise ValueError(f"unknown interpolation method {method!r}")
    df = nan_as_null(df)
    cols = _present(df, columns if columns is not None else numeric_columns(df, exclude=order))
    bl = blocked(df, order, keys, block_rows).drop("_halo")
    prev = bl.select("*", *[F.when(F.col(c).isNotNull(), F.struct(F.col("_idx").alias("i"), F.col(c).cast("double")
                                                                   .alias("v"))).alias(f"_p_{c}") for c in cols])
    for c in cols:
        prev = prev.withColumn(f"_n_{c}", F.col(f"_p_{c}"))
    prev = carry_fill(prev, [f"_p_{c}" for c in cols], keys, forward=True)
    nxt = carry_fill(prev, [f"_n_{c}" for c in cols], keys, forward=False)
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        held = F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
        if method == "linear":
            interp = p["v"] + (n["v"] - p["v"]) * (F.col("_idx") - p["i"]) / (n["i"] - p["i"])
            val = held.when(p.isNull(), F.lit(None)).when(n.isNull(), p["v"]).otherwise(interp)
        elif method == "pad":
            val = held.otherwise(p["v"])
        elif method == "bfill":
            val = held.otherwise(n["v"])
        else:
            near = F.col("_idx") - p["i"] <= n["i"] - F.col("_idx") if method == "nearest" else F.lit(True)
            val = held.when(p.isNull() | n.isNull(), F.lit(None)).otherwise(F.when(near, p["v"]).otherwise(n["v"]))
        out.append(val.cast(df.schema[c].dataType if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
                            else T.DoubleType()).alias(c))
    return nxt.select(*out)


def auto_fill(df: DataFrame, order: Sequence[str], numeric_strategy: str = "median",
              categorical_strategy: str = "mode", drop_threshold: float = 0.8,
              block_rows: int = DEFAULT_BLOCK_ROWS) -> tuple[DataFrame, dict]:
    """Drop columns above ``drop_threshold`` nulls, numeric by
    mean/median/zero, text by mode/'unknown', anything left by M6.

    The fit is three small jobs (null counts, means or exact medians, modes);
    the transform is one projection plus, only if other typed columns still
    hold nulls, the blocked fill."""
    df = nan_as_null(df)
    n, nulls = null_counts(df)
    keep = [c for c in df.columns if (nulls[c] / n if n else 0) <= drop_threshold]
    df = df.select(*keep)
    num = [c for c in numeric_columns(df) if nulls[c] > 0]
    txt = [c for c in string_columns(df) if nulls[c] > 0]
    fills: dict = {}
    if numeric_strategy == "mean":
        fills.update(fit_mean(df, num))
    elif numeric_strategy == "median":
        fills.update(fit_median(df, num))
    elif numeric_strategy == "zero":
        fills.update({c: 0 for c in num})
    else:
        raise ValueError(f"unknown numeric_strategy {numeric_strategy!r}")
    if categorical_strategy == "mode":
        fills.update(fit_mode(df, txt))
    elif categorical_strategy == "unknown":
        fills.update({c: "unknown" for c in txt})
    else:
        raise ValueError(f"unknown categorical_strategy {categorical_strategy!r}")
    out = apply_fill(df, fills)
    rest = [c for c in df.columns if nulls[c] > 0 and c not in fills]
    if rest:
        out = fill_forward(out, order, rest, block_rows=block_rows)
    return out, {"dropped": [c for c in nulls if c not in keep], "fills": fills}
