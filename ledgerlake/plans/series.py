"""Time-series and cell-store queries on ``v_bars`` / ``v_tick`` / events
(W1-W10, S12-S15, M12, T1, J6)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions.ordered import block_window, blocked, ewm_multi, ewm_sql, ordered_window_apply
from ..operators import cells as cl
from ..operators import series as ts
from ..operators.spline import fill_cubic
from ..sources.tables import table
from ..streaming.runner import table_stream
from ..streaming.state import last_n_stream
from .registry import register
from .views import V_BARS_SQL, V_TICK_SQL, v_bars, v_tick, with_ctes

PART = "PARTITION BY stock_code ORDER BY trade_date"


def _frame(n):
    return f"OVER ({PART} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _full(fn, c, n):
    return f"CASE WHEN count({c}) {_frame(n)} >= {n} THEN {fn}({c}) {_frame(n)} END"


def _feature_sql() -> list[tuple[str, str]]:
    cols = []
    for k in ts.LAGS:
        cols += [(f"close_lag_{k}", f"lag(close, {k}) OVER ({PART})"), (f"volume_lag_{k}", f"lag(volume, {k}) OVER ({PART})")]
    for n in ts.ROLL:
        cols += [(f"close_ma_{n}", _full("avg", "close", n)), (f"close_std_{n}", _full("stddev_samp", "close", n)),
                 (f"volume_ma_{n}", _full("avg", "volume", n))]
    for n in ts.MA:
        cols.append((f"ma{n}", _full("avg", "close", n)))
    cols += [("pct_change", f"close / lag(close) OVER ({PART}) - 1"), ("high_low_ratio", "high / low"),
             ("close_open_ratio", "close / open"), ("target_next_close", f"lead(close) OVER ({PART})")]
    return cols


FEATURES = _feature_sql()
A12, A26, A9 = (ts.span_alpha(s) for s in ts.MACD_SPANS)

STOCK_SQL_CTES = dict(
    b=V_BARS_SQL,
    d=f"SELECT *, coalesce(close - lag(close) OVER ({PART}), 0) AS dlt FROM b",
    g=f"""SELECT *,
      CASE WHEN count(*) {_frame(14)} >= 14 THEN avg(CASE WHEN dlt > 0 THEN dlt ELSE 0 END) {_frame(14)} END AS gain,
      CASE WHEN count(*) {_frame(14)} >= 14 THEN avg(CASE WHEN dlt < 0 THEN -dlt ELSE 0 END) {_frame(14)} END AS loss,
      {ewm_sql('close', A12, 'stock_code', 'trade_date')} AS ema12,
      {ewm_sql('close', A26, 'stock_code', 'trade_date')} AS ema26
    FROM d""",
    e=f"""SELECT *, round(ema12 - ema26, 4) AS macd_dif FROM g""",
    m=f"""SELECT *, round({ewm_sql('macd_dif', A9, 'stock_code', 'trade_date')}, 4) AS macd_dea FROM e""",
    f="SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in FEATURES) + """,
      round(100 - 100 / (1 + gain / CASE WHEN loss = 0 THEN 1e-10 ELSE loss END), 2) AS rsi_14,
      round(macd_dif - macd_dea, 4) AS macd_hist
    FROM m""",
)
BASE = ["stock_code", "trade_date", "open", "high", "low", "close", "volume"]
STOCK_OUT = BASE + [n for n, _ in FEATURES] + ["rsi_14", "macd_dif", "macd_dea", "macd_hist"]
DOUBLE_OUT = [c for c in STOCK_OUT if c not in ("stock_code", "trade_date", "volume")
              and not c.startswith("volume_lag")]


def _round(df, cols, digits=6):
    cols = set(cols)
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _sel_sql(cols, where=""):
    body = ", ".join(f"round({c}, 6) AS {c}" if c in DOUBLE_OUT else c for c in cols)
    return with_ctes(f"SELECT {body} FROM f {where}", **STOCK_SQL_CTES)


@register("stock_features", _sel_sql(STOCK_OUT, "WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in STOCK_OUT)))
def stock_features(spark, sf_dir):
    """The full indicator table, incomplete rows dropped."""
    out = ts.technical_indicators(v_bars(spark, sf_dir))
    return _round(out.select(*STOCK_OUT), DOUBLE_OUT)


def _light(spark, sf_dir, make, back=0, fwd=0):
    return ordered_window_apply(v_bars(spark, sf_dir), ["trade_date"], ["stock_code"], make, back, fwd).drop("_idx")


@register("sma_full", _sel_sql(["stock_code", "trade_date", "ma5", "ma10", "ma20", "ma60"]))
def sma_full(spark, sf_dir):
    """Full-window means, null until the window is full."""
    out = _light(spark, sf_dir, lambda w: [ts.full_mean("close", w, n).alias(f"ma{n}") for n in ts.MA], back=60)
    return _round(out.select("stock_code", "trade_date", *[f"ma{n}" for n in ts.MA]), [f"ma{n}" for n in ts.MA])


@register("rsi14", _sel_sql(["stock_code", "trade_date", "rsi_14"]))
def rsi14(spark, sf_dir):
    """W3 on the blocked plan: the 15-row halo covers the diff and the
    14-row frame of the first rows of every block."""
    bl = blocked(v_bars(spark, sf_dir), ["trade_date"], ["stock_code"], back=15)
    w = block_window(["stock_code"])
    bl = bl.withColumn("_delta", F.col("close") - F.lag("close").over(w))
    out = ts.rsi(bl, w).where(~F.col("_halo"))
    return _round(out.select("stock_code", "trade_date", "rsi_14"), ["rsi_14"])


@register("ewm12", with_ctes(f"SELECT stock_code, trade_date, round({ewm_sql('close', A12, 'stock_code', 'trade_date')}, 6)"
                             " AS ema12 FROM b", b=V_BARS_SQL))
def ewm12(spark, sf_dir):
    """Exact EWM (span 12, adjust=False) per stock."""
    out = ewm_multi(v_bars(spark, sf_dir), [("close", A12, "ema12")], ["trade_date"], ["stock_code"])
    return _round(out.select("stock_code", "trade_date", "ema12"), ["ema12"])


@register("macd", _sel_sql(["stock_code", "trade_date", "macd_dif", "macd_dea", "macd_hist"]))
def macd(spark, sf_dir):
    """DIF = EMA12 - EMA26, DEA = EMA9 of the rounded DIF, HIST."""
    out = ts.technical_indicators(v_bars(spark, sf_dir), drop_incomplete=False)
    return _round(out.select("stock_code", "trade_date", "macd_dif", "macd_dea", "macd_hist"),
                  ["macd_dif", "macd_dea", "macd_hist"])


@register("bar_ratios", with_ctes(f"""
SELECT stock_code, trade_date, round(close - lag(close) OVER ({PART}), 6) AS close_diff,
  round(close / lag(close) OVER ({PART}) - 1, 6) AS pct_change,
  round(high / low, 6) AS high_low_ratio, round(close / open, 6) AS close_open_ratio FROM b""", b=V_BARS_SQL))
def bar_ratios(spark, sf_dir):
    """Diff, percent change, high/low and close/open."""
    def make(w):
        prev = F.lag("close").over(w)
        return [(F.col("close") - prev).alias("close_diff"), (F.col("close") / prev - 1).alias("pct_change")]
    out = _light(spark, sf_dir, make, back=1)
    out = out.select("stock_code", "trade_date", "close_diff", "pct_change",
                     (F.col("high") / F.col("low")).alias("high_low_ratio"),
                     (F.col("close") / F.col("open")).alias("close_open_ratio"))
    return _round(out, ["close_diff", "pct_change", "high_low_ratio", "close_open_ratio"])


@register("next_close", with_ctes(f"SELECT stock_code, trade_date, close, lead(close) OVER ({PART}) AS target_next_close"
                                  " FROM b", b=V_BARS_SQL))
def next_close(spark, sf_dir):
    """Next row's close (lead over a forward halo)."""
    out = _light(spark, sf_dir, lambda w: [F.lead("close").over(w).alias("target_next_close")], fwd=1)
    return out.select("stock_code", "trade_date", "close", "target_next_close")


LAST_N = 10


@register("last_n_per_key", f"""
SELECT event_id, user_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r <= {LAST_N}""")
def last_n_per_key(spark, sf_dir):
    """The last 10 events of every account."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return ts.last_n_per_key(e, "user_id", ["ts", "event_id"], LAST_N)


@register("st_last_n", f"""
SELECT event_id, user_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r <= {LAST_N}""")
def st_last_n(spark, sf_dir):
    """W8 live: the last 10 events of every account as keyed list state."""
    out = last_n_stream(spark, table_stream(spark, sf_dir, "events", max_files=4), "user_id", "ts", "event_id",
                        ["event_id", "ts", "value"], LAST_N)
    return out.select("event_id", "user_id", "ts", "value")


@register("window_price_change", with_ctes("""
SELECT stock_code, window_start, round(avg_value, 6) AS avg_value, n,
  round((avg_value - lag(avg_value) OVER (PARTITION BY stock_code ORDER BY window_start))
        / lag(avg_value) OVER (PARTITION BY stock_code ORDER BY window_start) * 100, 6) AS change_pct
FROM (SELECT stock_code, date_trunc('day', ts) AS window_start, avg(price) AS avg_value, count(*) AS n
      FROM t GROUP BY 1, 2)""", t=V_TICK_SQL))
def window_price_change(spark, sf_dir):
    """Daily mean price per code and its change against the previous day."""
    out = ts.window_change(v_tick(spark, sf_dir), "stock_code", "ts", "price", "1 day")
    return _round(out, ["avg_value", "change_pct"])


# Every third month is missing; the spline's system by one sweep down and one up.
SPLINE_SQL = with_ctes("""SELECT stock_code, trade_date, round(coalesce(y, CASE WHEN p.i IS NOT NULL AND q.i IS NOT NULL THEN
    (q.x - s.x) / h * p.y + (s.x - p.x) / h * q.y + ((((q.x - s.x) / h) ** 3 - (q.x - s.x) / h) * p.m + (((s.x - p.x) / h) ** 3 - (s.x - p.x) / h) * q.m) * h * h / 6 END), 4) AS close
FROM (SELECT s.*, p, q, q.x - p.x AS h FROM s LEFT JOIN m2 p ON p.stock_code = s.stock_code AND p.i = s.before LEFT JOIN m2 q ON q.stock_code = s.stock_code AND q.i = s.before + 1) s""",
    b=V_BARS_SQL,
    s="""SELECT *, CASE WHEN y IS NULL THEN count(y) OVER (PARTITION BY stock_code ORDER BY x) END AS before FROM (
  SELECT stock_code, trade_date, CAST(row_number() OVER (PARTITION BY stock_code ORDER BY trade_date) - 1 AS DOUBLE) AS x,
    CASE WHEN month(trade_date) % 3 <> 0 THEN close END AS y FROM b)""",
    k="SELECT stock_code, x, y, row_number() OVER (PARTITION BY stock_code ORDER BY x) AS i, count(*) OVER (PARTITION BY stock_code) AS n FROM s WHERE y IS NOT NULL",
    e="""SELECT k.stock_code, k.i, k.n, k.x, k.y, CASE WHEN k.i IN (1, k.n) THEN 0.0 ELSE k.x - l.x END AS a,
  CASE WHEN k.i IN (1, k.n) THEN 1.0 ELSE 2 * (r.x - l.x) END AS b, CASE WHEN k.i IN (1, k.n) THEN 0.0 ELSE r.x - k.x END AS c,
  CASE WHEN k.i IN (1, k.n) THEN 0.0 ELSE 6 * ((r.y - k.y) / (r.x - k.x) - (k.y - l.y) / (k.x - l.x)) END AS d
  FROM k LEFT JOIN k l ON l.stock_code = k.stock_code AND l.i = k.i - 1 LEFT JOIN k r ON r.stock_code = k.stock_code AND r.i = k.i + 1""",
    fw="""WITH RECURSIVE f AS (SELECT stock_code, i, n, x, y, c / b AS cp, d / b AS dp FROM e WHERE i = 1 UNION ALL
  SELECT e.stock_code, e.i, e.n, e.x, e.y, e.c / (e.b - e.a * f.cp), (e.d - e.a * f.dp) / (e.b - e.a * f.cp) FROM f JOIN e ON e.stock_code = f.stock_code AND e.i = f.i + 1)
  SELECT * FROM f""",
    m2="""WITH RECURSIVE g AS (SELECT stock_code, i, x, y, dp AS m FROM fw WHERE i = n UNION ALL
  SELECT fw.stock_code, fw.i, fw.x, fw.y, fw.dp - fw.cp * g.m FROM g JOIN fw ON fw.stock_code = g.stock_code AND fw.i = g.i - 1) SELECT * FROM g""")


@register("fill_spline", SPLINE_SQL)
def fill_spline(spark, sf_dir):
    """M7, cubic: months without a close on the natural spline of their code,
    in blocks that the series cross."""
    b = v_bars(spark, sf_dir).select("stock_code", "trade_date", F.when(F.month("trade_date") % 3 != 0, F.col("close")).alias("close"))
    out = fill_cubic(b, ["trade_date"], "close", ["stock_code"], block_rows=32, block_knots=16)
    return out.withColumn("close", F.round("close", 4))


@register("ohlc_daily", with_ctes("""
SELECT stock_code, date_trunc('day', ts) AS period,
  arg_min(price, {'t': ts, 'k': event_id}) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, {'t': ts, 'k': event_id}) AS close, sum(volume) AS volume, count(*) AS ticks
FROM t GROUP BY 1, 2""", t=V_TICK_SQL))
def ohlc_daily(spark, sf_dir):
    """Daily bars from ticks."""
    return ts.ohlc(v_tick(spark, sf_dir), "stock_code", "ts", "price", "volume", "event_id")


# ------------------------------------------------------------------ cells
QUOTE = ["open", "high", "low", "close", "volume"]


def v_cells(spark, sf_dir):
    """Cells of ``v_bars``: version 1 puts every quote field; version 2
    re-puts a rounded close for bars whose volume is a multiple of 3."""
    b = v_bars(spark, sf_dir)
    key = cl.reversed_key(F.col("stock_code"), F.unix_date("trade_date").cast("long") * 86400)
    v1 = cl.to_cells(b, key, "quote", QUOTE, 1)
    fix = b.where(F.col("volume") % 3 == 0).withColumn("close", F.round("close", 0))
    v2 = cl.to_cells(fix, key, "quote", ["close"], 2)
    return v1.unionByName(v2)


_KEY_SQL = ("stock_code || '#' || lpad(CAST(9999999999 - date_diff('day', DATE '1970-01-01', trade_date) * 86400 "
            "AS VARCHAR), 10, '0')")
CELLS_CTES = dict(
    b=V_BARS_SQL,
    c=" UNION ALL ".join([f"SELECT {_KEY_SQL} AS row_key, 'quote' AS family, '{q}' AS qualifier, "
                          f"CAST({q} AS DOUBLE) AS value, 1 AS version FROM b" for q in QUOTE] +
                         [f"SELECT {_KEY_SQL} AS row_key, 'quote', 'close', round(close, 0), 2 FROM b WHERE volume % 3 = 0"]),
    r="SELECT row_key, " + ", ".join(
        f"max(CASE WHEN qualifier = '{q}' THEN value END) AS {q}" for q in QUOTE) + " FROM ("
      "SELECT row_key, qualifier, arg_max(value, version) AS value FROM c GROUP BY row_key, family, qualifier) GROUP BY row_key",
)


def _rows(spark, sf_dir):
    return cl.pivot_rows(v_cells(spark, sf_dir), "quote", QUOTE)


@register("cells_pivot", with_ctes("SELECT * FROM r", **CELLS_CTES))
def cells_pivot(spark, sf_dir):
    """Last write wins per cell, then one wide row per key."""
    return _rows(spark, sf_dir)


@register("prefix_scan", with_ctes("SELECT * FROM r WHERE starts_with(row_key, '1-URGENT#') ORDER BY row_key LIMIT 20",
                                   **CELLS_CTES))
def prefix_scan(spark, sf_dir):
    """Prefix scan in key order with a limit (the newest 20 bars)."""
    return cl.prefix_scan(_rows(spark, sf_dir), "1-URGENT#", 20)


POINT_KEY = "3-MEDIUM#" + str(cl.MAX_TS - (_dt.date(1998, 1, 1) - _dt.date(1970, 1, 1)).days * 86400).zfill(10)


@register("point_get", with_ctes(f"SELECT * FROM r WHERE row_key = '{POINT_KEY}'", **CELLS_CTES))
def point_get(spark, sf_dir):
    """One row by key."""
    return cl.point_get(_rows(spark, sf_dir), POINT_KEY)


@register("scan_to_bars", with_ctes(
    "SELECT split_part(row_key, '#', 1) AS stock_code, CAST(split_part(row_key, '#', 2) AS BIGINT) AS date_idx, "
    + ", ".join(f"coalesce({q}, 0.0) AS {q}" for q in QUOTE)
    + ", 9999999999 - CAST(split_part(row_key, '#', 2) AS BIGINT) AS epoch_seconds FROM r", **CELLS_CTES))
def scan_to_bars(spark, sf_dir):
    """Cells back to a typed bar frame."""
    return cl.scan_to_frame(_rows(spark, sf_dir), QUOTE)
