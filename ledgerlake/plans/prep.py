"""Preprocessing queries on ``v_loan`` (M, O, N, F, P) with DuckDB oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators import fitted as ft
from ..operators import missing as mv
from ..operators import outliers as ol
from ..operators import scaling as sc
from ..operators.pipeline import PreprocessingPipeline, load_config, merge_config, save_config
from ..session import scratch_path
from ..sources.tables import table
from .registry import register
from .views import LOAN_NUMERIC, LOAN_ORDER, V_LOAN_SQL, v_loan, with_ctes

KEYS = LOAN_ORDER
KEYS_SQL = ", ".join(KEYS)
ORDER_SQL = KEYS_SQL
LOAN_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "income",
                "credit_score", "debt_ratio", "tax", "loan_amount", "flag", "status", "ship_ts", "is_default"]
LOAN_TYPES = {"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_suppkey": "bigint",
              "l_extendedprice": "double", "income": "double", "credit_score": "double", "debt_ratio": "double",
              "tax": "double", "loan_amount": "double", "flag": "string", "status": "string",
              "ship_ts": "timestamp_ntz", "is_default": "int"}
ALL_NUMERIC = [c for c in LOAN_COLUMNS if LOAN_TYPES[c] in ("bigint", "int", "double")]
NULLABLE_NUM = ["income", "credit_score"]


def _sql(body: str, **extra) -> str:
    return with_ctes(body, v=V_LOAN_SQL, **extra)


def _r(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(F.col(c).cast("double"), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _r_sql(cols, digits: int = 6, skip=()) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) AS {c}" if c not in skip else c for c in cols)


def _loan(spark, sf_dir):
    return v_loan(spark, sf_dir)


# ------------------------------------------------------------------ M1
_MR_PARTS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, n_{c} AS missing_count, round(n_{c} * 100.0 / n, 2) AS missing_pct, "
    f"'{LOAN_TYPES[c]}' AS dtype, n - n_{c} AS non_missing FROM s" for c in LOAN_COLUMNS)
_MR_COUNTS = ", ".join(f"count(*) - count({c}) AS n_{c}" for c in LOAN_COLUMNS)


@register("missing_report", _sql(f"SELECT * FROM ({_MR_PARTS}) WHERE missing_count > 0",
                                 s=f"SELECT count(*) AS n, {_MR_COUNTS} FROM v"))
def missing_report(spark, sf_dir):
    return mv.missing_report(_loan(spark, sf_dir))


# ------------------------------------------------------------------ M2-M5
def _fill_sql(fills: dict[str, str], digits=6) -> str:
    cols = []
    for c in LOAN_COLUMNS:
        if c in fills:
            e = f"coalesce({c}, {fills[c]})"
            cols.append(f"round({e}, {digits}) AS {c}" if LOAN_TYPES[c] == "double" and digits else f"{e} AS {c}")
        else:
            cols.append(c)
    return ", ".join(cols)


@register("fill_constant", _sql(f"SELECT {_fill_sql({'income': '0', 'credit_score': '0', 'flag': chr(39) + '0' + chr(39)})} FROM v"))
def fill_constant(spark, sf_dir):
    return _r(mv.fill_constant(_loan(spark, sf_dir), fill_value=0), NULLABLE_NUM)


@register("fill_mean", _sql(f"SELECT {_fill_sql({c: f'(SELECT avg({c}) FROM v)' for c in NULLABLE_NUM})} FROM v"))
def fill_mean(spark, sf_dir):
    df, _ = mv.fill_mean(_loan(spark, sf_dir))
    return _r(df, NULLABLE_NUM)


@register("fill_median", _sql(f"SELECT {_fill_sql({c: f'(SELECT quantile_cont({c}, 0.5) FROM v)' for c in NULLABLE_NUM})} FROM v"))
def fill_median(spark, sf_dir):
    df, _ = mv.fill_median(_loan(spark, sf_dir))
    return _r(df, NULLABLE_NUM)


MODE_SQL = "(SELECT {c} FROM v WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@register("fill_mode", _sql(f"SELECT {_fill_sql({'flag': MODE_SQL.format(c='flag')})} FROM v"))
def fill_mode(spark, sf_dir):
    df, _ = mv.fill_mode(_loan(spark, sf_dir))
    return df


# ------------------------------------------------------------------ M6, M7
def _ff(c):
    return f"last_value({c} IGNORE NULLS) OVER (ORDER BY {ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _bf(c):
    return f"first_value({c} IGNORE NULLS) OVER (ORDER BY {ORDER_SQL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


_FF_INNER = ", ".join(f"{_ff(c)} AS {c}" if c in NULLABLE_NUM else c for c in LOAN_COLUMNS)
_FF_OUTER = ", ".join(f"coalesce({c}, {_bf(c)}) AS {c}" if c in NULLABLE_NUM + ["flag"] else c for c in LOAN_COLUMNS)


@register("fill_forward", _sql(f"SELECT {_FF_OUTER} FROM (SELECT {_FF_INNER} FROM v) x"))
def fill_forward(spark, sf_dir):
    return mv.fill_forward(_loan(spark, sf_dir), KEYS, NULLABLE_NUM)


def _interp_cols():
    inner = [f"row_number() OVER (ORDER BY {ORDER_SQL}) - 1 AS rn", *LOAN_COLUMNS]
    for c in NULLABLE_NUM:
        inner.append(f"CASE WHEN {c} IS NOT NULL THEN row_number() OVER (ORDER BY {ORDER_SQL}) - 1 END AS i_{c}")
    mid = ["*"]
    for c in NULLABLE_NUM:
        mid += [f"{_ff(c)} AS pv_{c}", f"{_ff('i_' + c)} AS pi_{c}", f"{_bf(c)} AS nv_{c}", f"{_bf('i_' + c)} AS ni_{c}"]
    outer = []
    for c in LOAN_COLUMNS:
        if c in NULLABLE_NUM:
            outer.append(f"round(CASE WHEN {c} IS NOT NULL THEN {c} WHEN pv_{c} IS NULL THEN NULL "
                         f"WHEN nv_{c} IS NULL THEN pv_{c} "
                         f"ELSE pv_{c} + (nv_{c} - pv_{c}) * (rn - pi_{c}) / (ni_{c} - pi_{c}) END, 6) AS {c}")
        else:
            outer.append(c)
    return ", ".join(inner), ", ".join(mid), ", ".join(outer)


_I1, _I2, _I3 = _interp_cols()


@register("fill_interpolate", _sql(f"SELECT {_I3} FROM (SELECT {_I2} FROM (SELECT {_I1} FROM v) a) b"))
def fill_interpolate(spark, sf_dir):
    return _r(mv.fill_interpolate(_loan(spark, sf_dir), KEYS, NULLABLE_NUM), NULLABLE_NUM)


# ------------------------------------------------------------------ M8
def _group_fill_sql(agg: str, cols) -> str:
    sel = ", ".join(f"{agg.format(c=c)} AS g_{c}" for c in cols)
    outs = []
    for c in LOAN_COLUMNS:
        if c in cols:
            e = f"coalesce(v.{c}, g.g_{c})"
            outs.append(f"round({e}, 6) AS {c}" if LOAN_TYPES[c] == "double" else f"{e} AS {c}")
        else:
            outs.append(f"v.{c}")
    return _sql(f"SELECT {', '.join(outs)} FROM v LEFT JOIN (SELECT status, {sel} FROM v GROUP BY status) g "
                f"ON v.status = g.status")


@register("fill_group_mean", _group_fill_sql("avg({c})", NULLABLE_NUM))
def fill_group_mean(spark, sf_dir):
    return _r(mv.fill_group(_loan(spark, sf_dir), "status", "mean", NULLABLE_NUM), NULLABLE_NUM)


@register("fill_group_median", _group_fill_sql("quantile_cont({c}, 0.5)", NULLABLE_NUM))
def fill_group_median(spark, sf_dir):
    return _r(mv.fill_group(_loan(spark, sf_dir), "status", "median", NULLABLE_NUM), NULLABLE_NUM)


_GMODE = ("(SELECT status, flag AS g_flag FROM (SELECT status, flag, row_number() OVER (PARTITION BY status "
          "ORDER BY count(*) DESC, flag) AS r FROM v WHERE flag IS NOT NULL GROUP BY status, flag) WHERE r = 1)")


@register("fill_group_mode", _sql("SELECT " + ", ".join(
    "coalesce(v.flag, g.g_flag) AS flag" if c == "flag" else f"v.{c}" for c in LOAN_COLUMNS) +
    f" FROM v LEFT JOIN {_GMODE} g ON v.status = g.status"))
def fill_group_mode(spark, sf_dir):
    return mv.fill_group(_loan(spark, sf_dir), "status", "mode", ["flag"])


_GMODE_NUM = ("(SELECT l_suppkey, credit_score AS g_score FROM (SELECT l_suppkey, credit_score, row_number() OVER "
              "(PARTITION BY l_suppkey ORDER BY count(*) DESC, credit_score) AS r FROM v WHERE credit_score IS NOT NULL "
              "GROUP BY l_suppkey, credit_score) WHERE r = 1)")


@register("fill_group_mode_numeric", _sql("SELECT " + ", ".join(
    "coalesce(v.credit_score, g.g_score) AS credit_score" if c == "credit_score" else f"v.{c}" for c in LOAN_COLUMNS) +
    f" FROM v LEFT JOIN {_GMODE_NUM} g ON v.l_suppkey = g.l_suppkey"))
def fill_group_mode_numeric(spark, sf_dir):
    """M8 on numbers: small groups tie often, the smallest number wins."""
    return mv.fill_group(_loan(spark, sf_dir), "l_suppkey", "mode", ["credit_score"])


# ------------------------------------------------ NaN is missing
def _loan_nan(spark, sf_dir):
    """The loan frame with NaN where it has nulls in floating columns."""
    return _loan(spark, sf_dir).withColumns({c: F.coalesce(F.col(c), F.lit(float("nan"))) for c in NULLABLE_NUM})


@register("missing_report_nan", _sql(f"SELECT * FROM ({_MR_PARTS}) WHERE missing_count > 0",
                                     s=f"SELECT count(*) AS n, {_MR_COUNTS} FROM v"))
def missing_report_nan(spark, sf_dir):
    return mv.missing_report(_loan_nan(spark, sf_dir))


@register("fill_mean_nan", _sql(f"SELECT {_fill_sql({c: f'(SELECT avg({c}) FROM v)' for c in NULLABLE_NUM})} FROM v"))
def fill_mean_nan(spark, sf_dir):
    return _r(mv.fill_mean(_loan_nan(spark, sf_dir))[0], NULLABLE_NUM)


# ------------------------------------------------------------------ M9-M11
SPARSE_COL_T = 0.05
_NR_PARTS = " UNION ALL ".join(f"SELECT '{c}' AS column_name, round(n_{c} * 1.0 / n, 6) AS null_ratio FROM s"
                               for c in LOAN_COLUMNS)


@register("drop_sparse_columns", _sql(f"SELECT * FROM ({_NR_PARTS}) WHERE null_ratio <= {SPARSE_COL_T}",
                                      s=f"SELECT count(*) AS n, {_MR_COUNTS} FROM v"))
def drop_sparse_columns(spark, sf_dir):
    """M9 as a report: the surviving columns and their null ratios."""
    df = _loan(spark, sf_dir)
    ratios = mv.null_ratios(df)
    kept = mv.drop_sparse_columns(df, SPARSE_COL_T).columns
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in kept])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                        F.round(F.col(c) / F.col("n"), 6).alias("null_ratio")) for c in kept]))
    assert all(ratios[c] <= SPARSE_COL_T for c in kept)
    return one.select(rows.alias("s")).select("s.*")


SPARSE_ROW_T = 0.1
_NULL_SUM = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in LOAN_COLUMNS)


@register("drop_sparse_rows", _sql(f"SELECT * FROM v WHERE ({_NULL_SUM}) / {len(LOAN_COLUMNS)} <= {SPARSE_ROW_T}"))
def drop_sparse_rows(spark, sf_dir):
    return mv.drop_sparse_rows(_loan(spark, sf_dir), SPARSE_ROW_T)


AUTO_FILLS = {**{c: f"(SELECT quantile_cont({c}, 0.5) FROM v)" for c in NULLABLE_NUM},
              "flag": MODE_SQL.format(c="flag")}


@register("auto_fill", _sql(f"SELECT {_fill_sql(AUTO_FILLS)} FROM v"))
def auto_fill(spark, sf_dir):
    df, _ = mv.auto_fill(_loan(spark, sf_dir), KEYS)
    return _r(df, NULLABLE_NUM)


@register("auto_fill_nan", _sql(f"SELECT {_fill_sql(AUTO_FILLS)} FROM v"))
def auto_fill_nan(spark, sf_dir):
    df, _ = mv.auto_fill(_loan_nan(spark, sf_dir), KEYS)
    return _r(df, NULLABLE_NUM)


# ------------------------------------------------------------------ O
OUT_COLS = LOAN_NUMERIC


def _q(c, p):
    return f"(SELECT quantile_cont({c}, {p}) FROM v)"


def _fence_sql(c, factor=1.5):
    q1, q3 = _q(c, 0.25), _q(c, 0.75)
    return f"({q1} - {factor} * ({q3} - {q1}))", f"({q3} + {factor} * ({q3} - {q1}))"


def _outside_sql(c, lo, hi):
    return f"coalesce({c} < {lo} OR {c} > {hi}, false)"


_REPORT_PARTS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {_q(c, 0.25)} AS q1, {_q(c, 0.75)} AS q3, {_q(c, 0.75)} - {_q(c, 0.25)} AS iqr, "
    f"{_fence_sql(c)[0]} AS lower_bound, {_fence_sql(c)[1]} AS upper_bound, "
    f"(SELECT count(*) FILTER (WHERE {_outside_sql(c, *_fence_sql(c))}) FROM v) AS outlier_count, "
    f"round((SELECT count(*) FILTER (WHERE {_outside_sql(c, *_fence_sql(c))}) FROM v) * 100.0 / (SELECT count(*) FROM v), 2)"
    f" AS outlier_pct" for c in OUT_COLS)


@register("outlier_iqr_report", _sql(f"SELECT column_name, {_r_sql(['q1', 'q3', 'iqr', 'lower_bound', 'upper_bound'])}, "
                                     f"outlier_count, outlier_pct FROM ({_REPORT_PARTS})"))
def outlier_iqr_report(spark, sf_dir):
    return _r(ol.iqr_report(_loan(spark, sf_dir), OUT_COLS), ["q1", "q3", "iqr", "lower_bound", "upper_bound"])


@register("outlier_iqr_mask", _sql(f"SELECT {KEYS_SQL}, " + ", ".join(
    f"{_outside_sql(c, *_fence_sql(c))} AS {c}" for c in OUT_COLS) + " FROM v"))
def outlier_iqr_mask(spark, sf_dir):
    return ol.iqr_mask(_loan(spark, sf_dir), KEYS, OUT_COLS)


def _z_sql(c, t):
    return (f"coalesce(abs({c} - (SELECT avg({c}) FROM v)) / (SELECT stddev_samp({c}) FROM v) > {t}, false)")


@register("outlier_zscore", _sql(f"SELECT {KEYS_SQL}, " + ", ".join(f"{_z_sql(c, 3.0)} AS {c}" for c in OUT_COLS)
                                 + " FROM v"))
def outlier_zscore(spark, sf_dir):
    return ol.zscore_mask(_loan(spark, sf_dir), KEYS, OUT_COLS, 3.0)


def _clip_sql(c, lo, hi):
    return f"round(CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {lo}), {hi}) END, 6) AS {c}"


@register("clip_iqr", _sql(f"SELECT {KEYS_SQL}, " + ", ".join(_clip_sql(c, *_fence_sql(c)) for c in OUT_COLS)
                           + " FROM v"))
def clip_iqr(spark, sf_dir):
    df, _ = ol.clip_outliers(_loan(spark, sf_dir), OUT_COLS, "iqr")
    return _r(df.select(*KEYS, *OUT_COLS), OUT_COLS)


@register("clip_quantile", _sql(f"SELECT {KEYS_SQL}, " + ", ".join(_clip_sql(c, _q(c, 0.01), _q(c, 0.99))
                                                                  for c in OUT_COLS) + " FROM v"))
def clip_quantile(spark, sf_dir):
    df, _ = ol.clip_outliers(_loan(spark, sf_dir), OUT_COLS, "quantile")
    return _r(df.select(*KEYS, *OUT_COLS), OUT_COLS)


@register("remove_iqr", _sql(f"SELECT {KEYS_SQL}, {', '.join(OUT_COLS)} FROM v WHERE NOT (" + " OR ".join(
    _outside_sql(c, *_fence_sql(c)) for c in OUT_COLS) + ")"))
def remove_iqr(spark, sf_dir):
    return ol.remove_outliers(_loan(spark, sf_dir), OUT_COLS, "iqr").select(*KEYS, *OUT_COLS)


@register("remove_zscore", _sql(f"SELECT {KEYS_SQL}, {', '.join(OUT_COLS)} FROM v WHERE NOT (" + " OR ".join(
    _z_sql(c, 3.0) for c in OUT_COLS) + ")"))
def remove_zscore(spark, sf_dir):
    return ol.remove_outliers(_loan(spark, sf_dir), OUT_COLS, "zscore", threshold=3.0).select(*KEYS, *OUT_COLS)


# ------------------------------------------------------------------ N
def _scaled_sql(expr_of) -> str:
    return _sql(f"SELECT {KEYS_SQL}, " + ", ".join(f"round({expr_of(c)}, 6) AS {c}" for c in OUT_COLS) + " FROM v")


def _minmax(c):
    mn, mx = f"(SELECT min({c}) FROM v)", f"(SELECT max({c}) FROM v)"
    return f"CASE WHEN {mx} = {mn} THEN 0.0 ELSE ({c} - {mn}) / ({mx} - {mn}) END"


@register("scale_minmax", _scaled_sql(_minmax))
def scale_minmax(spark, sf_dir):
    df, _ = sc.scale(_loan(spark, sf_dir), "minmax", OUT_COLS)
    return _r(df.select(*KEYS, *OUT_COLS), OUT_COLS)


@register("scale_zscore", _scaled_sql(lambda c: f"({c} - (SELECT avg({c}) FROM v)) / (SELECT stddev_samp({c}) FROM v)"))
def scale_zscore(spark, sf_dir):
    df, _ = sc.scale(_loan(spark, sf_dir), "zscore", OUT_COLS)
    return _r(df.select(*KEYS, *OUT_COLS), OUT_COLS)


def _robust(c):
    return f"({c} - {_q(c, 0.5)}) / ({_q(c, 0.75)} - {_q(c, 0.25)})"


@register("scale_robust", _scaled_sql(_robust))
def scale_robust(spark, sf_dir):
    df, _ = sc.scale(_loan(spark, sf_dir), "robust", OUT_COLS)
    return _r(df.select(*KEYS, *OUT_COLS), OUT_COLS)


LOG_COLS = ["margin", "income", "tax"]


def _log_frame(spark, sf_dir):
    return _loan(spark, sf_dir).select(*KEYS, (F.col("debt_ratio") - 0.05).alias("margin"), "income", "tax")


def _log_sql():
    # The offset grows with every column that has negatives and carries on.
    off, parts = "1.0", []
    for c in LOG_COLS:
        mn = f"(SELECT min({c}) FROM lv)"
        off = f"(CASE WHEN {mn} < 0 THEN abs({mn}) + {off} ELSE {off} END)"
        parts.append(f"round(ln({c} + {off}), 6) AS {c}")
    return with_ctes(f"SELECT {KEYS_SQL}, {', '.join(parts)} FROM lv", v=V_LOAN_SQL,
                     lv=f"SELECT {KEYS_SQL}, debt_ratio - 0.05 AS margin, income, tax FROM v")


@register("log_transform", _log_sql())
def log_transform(spark, sf_dir):
    df, _ = sc.scale(_log_frame(spark, sf_dir), "log", LOG_COLS)
    return _r(df, LOG_COLS)


@register("scale_inverse", _sql(f"SELECT {KEYS_SQL}, {_r_sql(OUT_COLS)} FROM v"))
def scale_inverse(spark, sf_dir):
    """inverse(robust(x)) gives x back."""
    df = _loan(spark, sf_dir)
    scaled, p = sc.scale(df, "robust", OUT_COLS)
    return _r(sc.inverse_transform(scaled, p).select(*KEYS, *OUT_COLS), OUT_COLS)


@register("params_roundtrip", _scaled_sql(_robust))
def params_roundtrip(spark, sf_dir):
    """Fitted parameters written as a JSON table, read back, applied."""
    df = _loan(spark, sf_dir)
    p = sc.fit_robust(df, OUT_COLS)
    path = scratch_path(spark, f"params/robust_{uuid.uuid4().hex}")
    sc.save_params(spark, p, path)
    back = sc.load_params(spark, path)
    return _r(sc.transform(df, back).select(*KEYS, *OUT_COLS), OUT_COLS)


@register("fit_extended", _sql("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, count(*) - count({c}) AS nulls, round(min({c}), 6) AS lo, round(max({c}), 6) AS hi, "
    f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, true AS median_close FROM v" for c in OUT_COLS) + ")"))
def fit_extended(spark, sf_dir):
    """A stored fit of one part of the table, extended by the other
    part; the median's rank is within 1 % of the middle."""
    df = _loan(spark, sf_dir)
    path = scratch_path(spark, f"params/fit_{uuid.uuid4().hex}")
    first = F.pmod(F.xxhash64(*KEYS), F.lit(3)) == 0
    for part in (df.where(first), df.where(~first)):
        ft.save_state(ft.fit_state(part, OUT_COLS), path)
    s = ft.statistics(ft.load_state(spark, path))
    at = {r["column"]: r["q_50"] for r in s.collect()}
    ranks = df.agg(*[(F.count(F.when(F.col(c) < at[c], 1)) / F.count(c)).alias(f"b{i}") for i, c in enumerate(OUT_COLS)],
                   *[(F.count(F.when(F.col(c) <= at[c], 1)) / F.count(c)).alias(f"a{i}") for i, c in enumerate(OUT_COLS)]).first()
    close = [c for i, c in enumerate(OUT_COLS) if ranks[f"b{i}"] <= 0.51 and ranks[f"a{i}"] >= 0.49]
    return s.select("column", "n", "nulls", *[F.round(c, 6).alias(c) for c in ("lo", "hi", "mean", "std")],
                    F.col("column").isin(close).alias("median_close"))


# ------------------------------------------------------------------ F1-F10, F14
_TF = {"year": "year(ts)", "month": "month(ts)", "day": "day(ts)", "hour": "hour(ts)", "minute": "minute(ts)",
       "dayofweek": "isodow(ts) - 1", "quarter": "quarter(ts)",
       "is_weekend": "CAST(isodow(ts) - 1 >= 5 AS INTEGER)", "is_month_start": "CAST(day(ts) = 1 AS INTEGER)",
       "is_month_end": "CAST(day(ts) = day(last_day(ts)) AS INTEGER)", "weekofyear": "week(ts)",
       "days_in_month": "day(last_day(ts))"}


@register("time_features", "SELECT event_id, ts, " + ", ".join(
    f"CAST({e} AS INTEGER) AS ts_{k}" for k, e in _TF.items()) + " FROM events")
def time_features(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    out = fe.extract_time_features(e, "ts")
    return out.select("event_id", "ts", *[F.col(f"ts_{k}").cast("int").alias(f"ts_{k}") for k in fe.TIME_FEATURES])


LAGS = [1, 3, 5]


@register("lag_features", "SELECT event_id, user_id, value, " + ", ".join(
    f"lag(value, {k}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value_lag{k}" for k in LAGS)
    + " FROM events")
def lag_features(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    return fe.create_lag_features(e, ["value"], LAGS, ["ts", "event_id"], "user_id").drop("ts")


@register("lag_features_global", "SELECT event_id, value, " + ", ".join(
    f"lag(value, {k}) OVER (ORDER BY event_id) AS value_lag{k}" for k in (1, 2)) + " FROM events")
def lag_features_global(spark, sf_dir):
    """F2 without a group (pandas ``shift`` on the whole frame): blocked plan."""
    e = table(spark, sf_dir, "events").select("event_id", "value")
    return fe.create_lag_features(e, ["value"], [1, 2], ["event_id"], None)


ROLL_W = [5, 10]
_RS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


@register("rolling_features", "SELECT event_id, user_id, " + ", ".join(
    f"round({fn}(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 6)"
    f" AS value_roll{w}_{s}" for w in ROLL_W for s, fn in _RS.items()) + " FROM events")
def rolling_features(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    out = fe.create_rolling_features(e, ["value"], ["ts", "event_id"], ROLL_W, list(_RS), "user_id")
    cols = [f"value_roll{w}_{s}" for w in ROLL_W for s in _RS]
    return _r(out.select("event_id", "user_id", *cols), cols)


PAIRS = [("income", "credit_score"), ("tax", "debt_ratio")]
_OPS_SQL = {"x": "{a} * {b}", "div": "{a} / ({b} + 1e-8)", "plus": "{a} + {b}", "minus": "{a} - {b}"}


@register("interactions", _sql(f"SELECT {KEYS_SQL}, " + ", ".join(
    f"round({e.format(a=a, b=b)}, 6) AS {a}_{k}_{b}" for a, b in PAIRS for k, e in _OPS_SQL.items()) + " FROM v"))
def interactions(spark, sf_dir):
    df = fe.create_interaction_features(_loan(spark, sf_dir), PAIRS, ["multiply", "divide", "add", "subtract"])
    cols = [f"{a}_{k}_{b}" for a, b in PAIRS for k in _OPS_SQL]
    return _r(df.select(*KEYS, *cols), cols)


@register("ratio_feature", _sql(f"SELECT {KEYS_SQL}, round(income / (credit_score + 1e-8), 6) AS income_per_score FROM v"))
def ratio_feature(spark, sf_dir):
    df = fe.create_ratio_feature(_loan(spark, sf_dir), "income", "credit_score", "income_per_score")
    return _r(df.select(*KEYS, "income_per_score"), ["income_per_score"])


_FIRST = "{" + ", ".join(f"'{k}': {k}" for k in KEYS) + "}"


@register("label_encode", _sql(
    f"SELECT {KEYS_SQL}, CAST(c.code AS INTEGER) AS flag FROM v LEFT JOIN "
    f"(SELECT flag, row_number() OVER (ORDER BY f) - 1 AS code FROM "
    f"(SELECT flag, min({_FIRST}) AS f FROM v WHERE flag IS NOT NULL GROUP BY flag)) c USING (flag)"))
def label_encode(spark, sf_dir):
    df, _ = fe.label_encode(_loan(spark, sf_dir), ["flag"], KEYS)
    return df.select(*KEYS, "flag")


@register("label_alpha", _sql(f"SELECT {KEYS_SQL}, CAST(dense_rank() OVER (ORDER BY coalesce(flag, 'nan')) - 1 AS INTEGER)"
                              " AS flag FROM v"))
def label_alpha(spark, sf_dir):
    return fe.alpha_encode(_loan(spark, sf_dir), ["flag"]).select(*KEYS, "flag")


@register("onehot", _sql(f"SELECT {KEYS_SQL}, coalesce(CAST(flag = 'N' AS INTEGER), 0) AS flag_N, "
                         "coalesce(CAST(flag = 'R' AS INTEGER), 0) AS flag_R, "
                         "coalesce(CAST(status = 'O' AS INTEGER), 0) AS status_O FROM v"))
def onehot(spark, sf_dir):
    df = fe.onehot_encode(_loan(spark, sf_dir).select(*KEYS, "flag", "status"), ["flag", "status"])
    return df


@register("target_encode", _sql(
    f"SELECT {KEYS_SQL}, " + ", ".join(
        f"round(coalesce((SELECT avg(is_default) FROM v x WHERE x.{c} = v.{c}), (SELECT avg(is_default) FROM v)), 6)"
        f" AS {c}_target_enc" for c in ("flag", "status")) + " FROM v"))
def target_encode(spark, sf_dir):
    df = fe.target_encode(_loan(spark, sf_dir), ["flag", "status"], "is_default")
    cols = ["flag_target_enc", "status_target_enc"]
    return _r(df.select(*KEYS, *cols), cols)


SEL_COLS = [c for c in ALL_NUMERIC if c != "is_default"]


def _selection_report(df, values: dict, name: str, keep: list[str], digits: int):
    """Fit result as a lazy report: one aggregate row unpivoted to
    (column_name, value) for the selected columns."""
    row = df.agg(*[values[c].alias(c) for c in SEL_COLS])
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.round(F.col(c), digits).alias(name))
                             for c in SEL_COLS]))
    return row.select(st.alias("s")).select("s.*").where(F.col("column_name").isin(keep) if keep else F.lit(False))


CORR_COLS = [c for c in ALL_NUMERIC if c != "credit_score"]


@register("select_corr", _sql("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(corr({c}, credit_score), 6) AS corr FROM v" for c in CORR_COLS)
    + ") WHERE abs(corr) >= 0.05"))
def select_corr(spark, sf_dir):
    """columns whose |Pearson r| with credit_score is at least 0.05
    (pairwise complete: rows with a null on either side are skipped)."""
    df = _loan(spark, sf_dir).select(*ALL_NUMERIC)
    keep = fe.select_features_by_correlation(df, "credit_score", 0.05)
    vals = {c: F.corr(F.col(c).cast("double"), F.col("credit_score").cast("double")) for c in CORR_COLS}
    row = df.agg(*[vals[c].alias(c) for c in CORR_COLS])
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.round(F.col(c), 6).alias("corr"))
                             for c in CORR_COLS]))
    return row.select(st.alias("s")).select("s.*").where(F.col("column_name").isin(keep) if keep else F.lit(False))


@register("select_variance", _sql("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, var_samp({c}) AS v FROM v" for c in SEL_COLS).replace(" AS v FROM", " AS v FROM")
    + ") x" ).replace("SELECT * FROM (", "SELECT column_name, round(v, 3) AS variance FROM (", 1) + " WHERE v > 0.01")
def select_variance(spark, sf_dir):
    """columns with sample variance above 0.01 (reported to 3 dp)."""
    df = _loan(spark, sf_dir).select(*SEL_COLS)
    keep = fe.select_features_by_variance(df, 0.01)
    return _selection_report(df, {c: F.var_samp(c) for c in SEL_COLS}, "variance", keep, 3)


# ------------------------------------------------------------------ P1, P3
def _pipeline_sql() -> str:
    """The default pipeline as SQL: median / mode fill, IQR clip of every
    numeric column, robust scaling of the clipped values."""
    fills = _fill_sql(AUTO_FILLS, digits=None)
    clip_cols = []
    for c in LOAN_COLUMNS:
        if c in ALL_NUMERIC:
            q1, q3 = f"(SELECT quantile_cont({c}, 0.25) FROM f)", f"(SELECT quantile_cont({c}, 0.75) FROM f)"
            lo, hi = f"({q1} - 1.5 * ({q3} - {q1}))", f"({q3} + 1.5 * ({q3} - {q1}))"
            clip_cols.append(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest(CAST({c} AS DOUBLE), {lo}), {hi}) END AS {c}")
        else:
            clip_cols.append(c)
    sc_cols = []
    for c in LOAN_COLUMNS:
        if c in ALL_NUMERIC:
            q1, q2, q3 = (f"(SELECT quantile_cont({c}, {p}) FROM k)" for p in (0.25, 0.5, 0.75))
            sc_cols.append(f"round(CASE WHEN {q3} - {q1} = 0 THEN 0.0 ELSE ({c} - {q2}) / ({q3} - {q1}) END, 6) AS {c}")
        else:
            sc_cols.append(c)
    return with_ctes(f"SELECT {', '.join(sc_cols)} FROM k", v=V_LOAN_SQL, f=f"SELECT {fills} FROM v",
                     k=f"SELECT {', '.join(clip_cols)} FROM f")


@register("pipeline_default", _pipeline_sql())
def pipeline_default(spark, sf_dir):
    """P1 with the reference's default config (D7 parity: every numeric
    column, ids included, is clipped and scaled)."""
    p = PreprocessingPipeline(order=KEYS)
    out = p.run(_loan(spark, sf_dir))
    return _r(out, ALL_NUMERIC)


# Row counts stay, the default run changes no column: five steps.
_STEPS = ["input", "missing_value", "outlier", "normalization", "feature_engineering"]
_STEP_DETAILS = ["{}", '{"strategy": "auto"}', '{"action": "clip", "method": "iqr"}', '{"method": "robust"}', "{}"]


@register("pipeline_report", " UNION ALL ".join(
    f"SELECT {i} AS step_no, '{s}' AS step, count(*) AS rows, {len(LOAN_COLUMNS)} AS columns, '{d}' AS details FROM lineitem"
    for i, (s, d) in enumerate(zip(_STEPS, _STEP_DETAILS))))
def pipeline_report(spark, sf_dir):
    """Per-step rows and columns through the default pipeline."""
    p = PreprocessingPipeline(order=KEYS)
    p.run(_loan(spark, sf_dir))
    return p.report(spark).drop("fit_sec")


def _only(**sections):
    """A configuration with the named sections on and the others off."""
    off = {s: {"enabled": False} for s in ("missing_value", "outlier", "normalization", "feature_engineering")}
    return {**off, **{s: {"enabled": True, **v} for s, v in sections.items()}}


_PIPE_TIME = ["year", "dayofweek", "is_month_end"]


@register("pipeline_time_features", _sql(f"SELECT {', '.join(LOAN_COLUMNS)}, " + ", ".join(
    f"CAST({_TF[k].replace('(ts', '(ship_ts').replace('day(ts', 'day(ship_ts')} AS INTEGER) AS ship_ts_{k}" for k in _PIPE_TIME) + " FROM v"))
def pipeline_time_features(spark, sf_dir):
    """Time features given as column and parts."""
    p = PreprocessingPipeline(_only(feature_engineering={"time_features": {"column": "ship_ts", "features": _PIPE_TIME}}), order=KEYS)
    out = p.run(_loan(spark, sf_dir))
    return out.withColumns({f"ship_ts_{k}": F.col(f"ship_ts_{k}").cast("int") for k in _PIPE_TIME})


# l_suppkey % 10 = 1 empties flag for a tenth of the rows, more than any other column.
@register("pipeline_drop", _sql(f"SELECT {', '.join(c for c in LOAN_COLUMNS if c != 'flag')} FROM v"))
def pipeline_drop(spark, sf_dir):
    """Strategy ``drop`` leaves out columns with too many nulls."""
    p = PreprocessingPipeline(_only(missing_value={"strategy": "drop", "drop_threshold": 0.08}), order=KEYS)
    return p.run(_loan(spark, sf_dir))


@register("pipeline_remove", _sql(f"SELECT {', '.join(LOAN_COLUMNS)} FROM v WHERE NOT (" + " OR ".join(
    _outside_sql(c, *_fence_sql(c)) for c in OUT_COLS) + ")"))
def pipeline_remove(spark, sf_dir):
    """Action ``remove`` over chosen columns."""
    p = PreprocessingPipeline(_only(outlier={"method": "iqr", "action": "remove", "columns": OUT_COLS}), order=KEYS)
    return p.run(_loan(spark, sf_dir))


@register("pipeline_detect_only", _sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {_z_sql(c, 3.0)}) AS outliers, count(*) AS rows FROM v" for c in OUT_COLS)))
def pipeline_detect_only(spark, sf_dir):
    """Action ``detect_only`` counts and leaves the rows as they are."""
    p = PreprocessingPipeline(_only(outlier={"method": "zscore", "action": "detect_only", "factor": 3.0, "columns": OUT_COLS}), order=KEYS)
    rows = p.run(_loan(spark, sf_dir)).agg(F.count(F.lit(1)).alias("rows"))
    found = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(n).cast("long").alias("outliers"))
                                for c, n in p.params["outlier"].items()]))
    return rows.select(found.alias("s"), "rows").select("s.*", "rows")


@register("pipeline_config", _sql(f"SELECT {', '.join(LOAN_COLUMNS)} FROM v WHERE NOT (" + " OR ".join(
    _z_sql(c, 3.0) for c in OUT_COLS) + ")"))
def pipeline_config(spark, sf_dir):
    """A user configuration merged over the defaults, saved, loaded and
    run: rows beyond three standard deviations removed, nothing else."""
    cfg = merge_config(_only(outlier={"method": "zscore", "action": "remove", "factor": 3.0, "columns": OUT_COLS}))
    path = scratch_path(spark, f"params/pipeline_{uuid.uuid4().hex}")
    save_config(spark, cfg, path)
    return PreprocessingPipeline(load_config(spark, path), order=KEYS).run(_loan(spark, sf_dir))
