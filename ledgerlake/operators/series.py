"""Time-series operators (W1-W10): lags, full-window rolling means, RSI,
EWM / MACD, bar ratios, next value, last-N, window-over-window change and
OHLC bars.  Per-key ordered windows run on the blocked plan of
``functions.ordered``, so neither a keyless frame nor a hot key lands in one
task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import DEFAULT_BLOCK_ROWS, blocked, ewm_multi
from .relational import top_k_per_group_split

LAGS = [1, 2, 3, 5]
ROLL = [5, 10, 20]
MA = [5, 10, 20, 60]
RSI_N = 14
MACD_SPANS = (12, 26, 9)


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def full_mean(c: str, w: Window, n: int) -> Column:
    """pandas ``rolling(n).mean()``: null until n values are in the frame."""
    fr = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(fr) >= n, F.avg(c).over(fr))


def full_std(c: str, w: Window, n: int) -> Column:
    fr = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(fr) >= n, F.stddev_samp(c).over(fr))


def _window_cols(w: Window, close: str, volume: str, high: str, low: str, open_: str) -> list[Column]:
    cols = []
    for k in LAGS:
        cols += [F.lag(close, k).over(w).alias(f"close_lag_{k}"), F.lag(volume, k).over(w).alias(f"volume_lag_{k}")]
    for n in ROLL:
        cols += [full_mean(close, w, n).alias(f"close_ma_{n}"), full_std(close, w, n).alias(f"close_std_{n}"),
                 full_mean(volume, w, n).alias(f"volume_ma_{n}")]
    for n in MA:
        cols.append(full_mean(close, w, n).alias(f"ma{n}"))
    prev = F.lag(close, 1).over(w)
    cols += [
        (F.col(close) - prev).alias("_delta"),
        (F.col(close) / prev - 1).alias("pct_change"),
        (F.col(high) / F.col(low)).alias("high_low_ratio"),
        (F.col(close) / F.col(open_)).alias("close_open_ratio"),
        F.lead(close, 1).over(w).alias("target_next_close"),
    ]
    return cols


def rsi(df: DataFrame, w: Window, n: int = RSI_N, delta: str = "_delta") -> DataFrame:
    """Simple-mean gains and losses over n rows (the first delta counts
    as 0), zero loss replaced by 1e-10, rounded half-even to 2 dp."""
    d = F.coalesce(F.col(delta), F.lit(0.0))
    gain = F.when(d > 0, d).otherwise(F.lit(0.0))
    loss = F.when(d < 0, -d).otherwise(F.lit(0.0))
    out = df.withColumn("_gain", gain).withColumn("_loss", loss)
    fr = w.rowsBetween(-(n - 1), 0)
    full = F.count(F.lit(1)).over(fr) >= n
    g = F.when(full, F.avg("_gain").over(fr))
    lo = F.when(full, F.avg("_loss").over(fr))
    rs = g / F.when(lo == 0, F.lit(1e-10)).otherwise(lo)
    return out.withColumn("rsi_14", F.bround(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs), 2)).drop("_gain", "_loss")


def technical_indicators(bars: DataFrame, key: str = "stock_code", order: Sequence[str] = ("trade_date",),
                         close: str = "close", volume: str = "volume", high: str = "high", low: str = "low",
                         open_: str = "open", block_rows: int = DEFAULT_BLOCK_ROWS,
                         drop_incomplete: bool = True, descending: bool = False) -> DataFrame:
    """W1-W7 (+M12): the stock case's feature table.

    Order is true time ascending; ``descending=True`` reproduces the
    reference's reversed-timestamp order (D2).  One dense index serves the
    blocked windows and the EWM chain."""
    order = list(order)
    if descending:
        bars = bars.withColumn("_neg_order", -F.unix_date(F.col(order[0]).cast("date")))
        order = ["_neg_order"]
    bl = blocked(bars, order, [key], block_rows, back=max(MA), fwd=1)
    w = Window.partitionBy(key, "_blk").orderBy("_idx")
    feats = bl.select("*", *_window_cols(w, close, volume, high, low, open_))
    feats = rsi(feats, w).where(~F.col("_halo")).drop("_halo", "_blk")
    a12, a26, a9 = (span_alpha(s) for s in MACD_SPANS)
    feats = ewm_multi(feats, [(close, a12, "_ema12"), (close, a26, "_ema26")], order, [key], indexed=True)
    feats = feats.withColumn("macd_dif", F.bround(F.col("_ema12") - F.col("_ema26"), 4))
    feats = ewm_multi(feats, [("macd_dif", a9, "_dea")], order, [key], indexed=True)
    feats = (feats.withColumn("macd_dea", F.bround("_dea", 4))
                  .withColumn("macd_hist", F.bround(F.col("macd_dif") - F.col("macd_dea"), 4)))
    out = feats.drop("_ema12", "_ema26", "_dea", "_delta", "_idx")
    if descending:
        out = out.drop("_neg_order")
    if drop_incomplete:
        out = out.na.drop("any")
    return out


def last_n_per_key(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """W8 (batch): the last n rows of every key (ranked in parts of a key
    first, so a hot key is many tasks' work)."""
    return top_k_per_group_split(df, [key], n, [F.desc(o) for o in order], "_r").drop("_r")


def window_change(df: DataFrame, key: str, ts: str, value: str, size: str) -> DataFrame:
    """Mean per (key, tumbling window) and its percent change against
    the key's previous window.  The window table has one row per (key,
    window), so the lag over it is small per key."""
    agg = df.groupBy(key, F.window(ts, size).alias("w")).agg(F.avg(value).alias("avg_value"),
                                                             F.count(F.lit(1)).alias("n"))
    agg = agg.select(key, F.col("w.start").alias("window_start"), "avg_value", "n")
    w = Window.partitionBy(key).orderBy("window_start")
    prev = F.lag("avg_value").over(w)
    return agg.withColumn("change_pct", (F.col("avg_value") - prev) / prev * 100)


def ohlc(df: DataFrame, key: str, ts: str, price: str, volume: str, tiebreak: str, unit: str = "day") -> DataFrame:
    """open/high/low/close/volume per key and calendar unit; open and
    close are ``min_by`` / ``max_by`` on (ts, tie-breaker)."""
    order = F.struct(F.col(ts), F.col(tiebreak))
    period = F.date_trunc(unit, F.col(ts)).alias("period")
    return df.groupBy(key, period).agg(
        F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, order).alias("close"), F.sum(volume).alias("volume"), F.count(F.lit(1)).alias("ticks"))
