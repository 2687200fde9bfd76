"""Feature engineering, encoding and selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import EPS, inf_to_null, numeric_columns
from ..functions.ordered import DEFAULT_BLOCK_ROWS, dense_index, ordered_window_apply
from .relational import join_groups

TIME_FEATURES = ["year", "month", "day", "hour", "minute", "dayofweek", "quarter", "is_weekend",
                 "is_month_start", "is_month_end", "weekofyear", "days_in_month"]


def time_feature_exprs(ts: Column) -> dict[str, Column]:
    """The 12 calendar parts; Monday is 0, ISO week number."""
    dom = F.dayofmonth(ts)
    dim = F.dayofmonth(F.last_day(ts))
    wd = F.weekday(ts)
    return {
        "year": F.year(ts), "month": F.month(ts), "day": dom, "hour": F.hour(ts), "minute": F.minute(ts),
        "dayofweek": wd, "quarter": F.quarter(ts),
        "is_weekend": (wd >= 5).cast("int"),
        "is_month_start": (dom == 1).cast("int"),
        "is_month_end": (dom == dim).cast("int"),
        "weekofyear": F.weekofyear(ts), "days_in_month": dim,
    }


def extract_time_features(df: DataFrame, time_col: str, features: Sequence[str] | None = None) -> DataFrame:
    """``{time_col}_{part}`` columns appended.  Text that does not parse
    becomes null (``try_to_timestamp``), and null stays null in every part."""
    dt = df.schema[time_col].dataType
    ts = F.col(time_col)
    if isinstance(dt, T.StringType):
        ts = F.try_to_timestamp(ts)
    ex = time_feature_exprs(ts)
    feats = [f for f in (features or TIME_FEATURES) if f in ex]
    return df.select("*", *[ex[f].alias(f"{time_col}_{f}") for f in feats])


def create_lag_features(df: DataFrame, columns: Sequence[str], lags: Sequence[int], order: Sequence[str],
                        group_col: str | None = None, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """value k rows earlier (per group when ``group_col`` is given).
    Runs as a blocked window: no single-task window even without a group, and
    a hot group is spread over blocks."""
    keys = [group_col] if group_col else []
    mk = lambda w: [F.lag(c, k).over(w).alias(f"{c}_lag{k}") for c in columns for k in lags]
    out = ordered_window_apply(df, order, keys, mk, back=max(lags), block_rows=block_rows)
    return out.drop("_idx")


ROLL_STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def create_rolling_features(df: DataFrame, columns: Sequence[str], order: Sequence[str],
                            windows: Sequence[int] = (5, 10, 20), stats: Sequence[str] = ("mean", "std", "min", "max"),
                            group_col: str | None = None, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """statistics over the last w rows with ``min_periods=1`` (the std of
    one row is null).  One frame spec per window size is shared by all its
    statistics, so Spark evaluates them in one Window operator."""
    keys = [group_col] if group_col else []

    def mk(w):
        out = []
        for c in columns:
            for win in windows:
                fr = w.rowsBetween(-(win - 1), 0)
                for s in stats:
                    out.append(ROLL_STATS[s](c).over(fr).alias(f"{c}_roll{win}_{s}"))
        return out
    res = ordered_window_apply(df, order, keys, mk, back=max(windows) - 1, block_rows=block_rows)
    return res.drop("_idx")


PAIR_OPS = {
    "multiply": lambda a, b: a * b,
    "divide": lambda a, b: F.try_divide(a, b + F.lit(EPS)),
    "add": lambda a, b: a + b,
    "subtract": lambda a, b: a - b,
}
PAIR_SUFFIX = {"multiply": "x", "divide": "div", "add": "plus", "subtract": "minus"}


def create_interaction_features(df: DataFrame, column_pairs: Sequence[tuple[str, str]],
                                operations: Sequence[str] = ("multiply", "divide")) -> DataFrame:
    """pair expressions; unknown columns or operations are skipped."""
    new = []
    for a, b in column_pairs:
        if a not in df.columns or b not in df.columns:
            continue
        for op in operations:
            if op in PAIR_OPS:
                new.append(inf_to_null(PAIR_OPS[op](F.col(a).cast("double"), F.col(b).cast("double")))
                           .alias(f"{a}_{PAIR_SUFFIX[op]}_{b}"))
    return df.select("*", *new)


def create_ratio_feature(df: DataFrame, numerator: str, denominator: str, feature_name: str | None = None) -> DataFrame:
    """num / (den + 1e-8); infinities become null."""
    name = feature_name or f"{numerator}_to_{denominator}_ratio"
    v = F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double") + F.lit(EPS))
    return df.withColumn(name, inf_to_null(v))


def label_encode(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """integer code by first appearance in ``order``; null stays null.

    Per value the first position is a ``min`` aggregate (decomposable), the
    codes are a dense index over the distinct values, and the code table is
    joined back (broadcast by AQE when small)."""
    out = df
    maps = {}
    first = F.struct(*[F.col(o) for o in order])
    for c in columns:
        firsts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.min(first).alias("_first"))
        codes = dense_index(firsts, ["_first"], "_code").select(c, F.col("_code").cast("int").alias(f"_code_{c}"))
        maps[c] = codes.withColumnRenamed(f"_code_{c}", "code")
        out = out.join(codes, c, "left")
        out = out.withColumn(c, F.col(f"_code_{c}")).drop(f"_code_{c}")
    return out.select(*df.columns), maps


def alpha_encode(df: DataFrame, columns: Sequence[str], null_as: str | None = "nan") -> DataFrame:
    """sorted distinct values get 0..k-1 (``LabelEncoder``); with
    ``null_as`` nulls take part as that text."""
    out = df
    for c in columns:
        v = F.coalesce(F.col(c).cast("string"), F.lit(null_as)) if null_as is not None else F.col(c).cast("string")
        out = out.withColumn(c, v)
        codes = dense_index(out.select(c).where(F.col(c).isNotNull()).distinct(), [c], "_code")
        out = out.join(codes.select(c, F.col("_code").cast("int").alias("_code")), c, "left")
        out = out.withColumn(c, F.col("_code")).drop("_code")
    return out.select(*df.columns)


def onehot_encode(df: DataFrame, columns: Sequence[str], drop_first: bool = True,
                  max_categories: int = 10000) -> DataFrame:
    """one 0/1 column per sorted category (first dropped by default), the
    source column removed; null gives all zeros.  The category list is
    collected to build the projection, so its size is checked first."""
    out = df
    for c in columns:
        n = out.select(c).where(F.col(c).isNotNull()).distinct().count()
        if n > max_categories:
            raise ValueError(f"{c}: {n} categories exceed max_categories={max_categories}")
        cats = sorted(r[0] for r in out.select(c).where(F.col(c).isNotNull()).distinct().collect())
        if drop_first:
            cats = cats[1:]
        dummies = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}") for v in cats]
        out = out.select(*[x for x in out.columns if x != c], *dummies)
    return out


def target_encode(df: DataFrame, columns: Sequence[str], target_col: str) -> DataFrame:
    """F8: ``{c}_target_enc`` = mean target of the category; unseen or null
    categories take the global mean (in-sample, as the reference does)."""
    gmean = df.agg(F.avg(target_col)).first()[0]
    out = df
    for c in columns:
        m = df.groupBy(c).agg(F.avg(target_col).alias(f"{c}_target_enc"), F.count(F.lit(1)).alias("_rows"))
        out = join_groups(out, m, c)
        out = out.withColumn(f"{c}_target_enc", F.coalesce(F.col(f"{c}_target_enc"), F.lit(gmean)))
    return out.select(*df.columns, *[f"{c}_target_enc" for c in columns])


def correlations(df: DataFrame, target_col: str, columns=None) -> dict[str, float | None]:
    cols = [c for c in (columns or numeric_columns(df)) if c != target_col]
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target_col).cast("double")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def select_features_by_correlation(df: DataFrame, target_col: str, threshold: float = 0.05) -> list[str]:
    """numeric columns with |Pearson r| to the target at least t."""
    return [c for c, r in correlations(df, target_col).items() if r is not None and abs(r) >= threshold]


def variances(df: DataFrame, columns=None) -> dict[str, float | None]:
    cols = columns or numeric_columns(df)
    row = df.agg(*[F.var_samp(c).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def select_features_by_variance(df: DataFrame, threshold: float = 0.01) -> list[str]:
    """numeric columns with sample variance strictly above t."""
    return [c for c, v in variances(df).items() if v is not None and v > threshold]
