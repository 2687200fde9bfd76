"""Monitoring operators shared by the batch queries and the streams: tick
window metrics and alerts (ST1-ST5), account window stats and rules
(ST6-ST11, A6, A10), implicit feedback and counters (ST12-ST14, S16, S17).

Every function takes a DataFrame and returns a DataFrame, so the same plan
runs on a static table or on a ``readStream`` source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the monitoring cases: price surge above 3% (HIGH above
# twice that), volume anomaly above 5x the baseline, baseline EMA weights
# 0.8 / 0.2, large amount at least 50000, odd hours 0-5, high frequency at
# least 8 per window, multi-city at least 3 cities, behaviour weights
# browse 1, click 2, purchase 5, rate = rating * 1.5 (unknown behaviour 1).
PRICE_CHANGE_PCT = 3.0
VOLUME_MULTIPLIER = 5.0
BASELINE_ALPHA = 0.2
LARGE_AMOUNT = 50000
ODD_HOURS = (0, 5)
HIGH_FREQ = 8
MULTI_CITY = 3
BEHAVIOUR_WEIGHT = {"browse": 1.0, "click": 2.0, "purchase": 5.0}
RATE_FACTOR = 1.5
ITEM_CATEGORIES = ["programming", "ai", "math", "ops"]  # item_id % 4 -> category

ALERT_COLUMNS = ["rule", "severity", "key", "event_id", "detail", "ts"]


def tick_window_metrics(ticks: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """ST1: per (code, event-time window): mean, max, min, population-std
    volatility, total and mean volume, tick count."""
    win = F.window("ts", size, slide) if slide else F.window("ts", size)
    agg = ticks.groupBy("stock_code", win.alias("w")).agg(
        F.avg("price").alias("avg_price"), F.max("price").alias("max_price"), F.min("price").alias("min_price"),
        F.stddev_pop("price").alias("_std"), F.sum("volume").alias("total_volume"),
        F.avg("volume").alias("avg_volume"), F.count(F.lit(1)).alias("tick_count"))
    return agg.select("stock_code", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "avg_price", "max_price", "min_price",
                      F.when(F.col("avg_price") > 0, F.col("_std") / F.col("avg_price")).otherwise(F.lit(0.0))
                      .alias("volatility"), "total_volume", "avg_volume", "tick_count")


def price_surge_alerts(changes: DataFrame, threshold: float = PRICE_CHANGE_PCT) -> DataFrame:
    """ST4: |change| above the threshold; HIGH above twice it."""
    a = F.abs(F.col("change_pct"))
    return changes.where(a > threshold).select(
        F.lit("PRICE_SURGE").alias("rule"),
        F.when(a > 2 * threshold, F.lit("HIGH")).otherwise(F.lit("MEDIUM")).alias("severity"),
        F.col("stock_code").cast("string").alias("key"), F.lit(None).cast("long").alias("event_id"),
        F.when(F.col("change_pct") > 0, F.lit("up")).otherwise(F.lit("down")).alias("detail"),
        F.col("window_start").alias("ts"))


def volume_alerts(win: DataFrame, multiplier: float = VOLUME_MULTIPLIER) -> DataFrame:
    """ST5: window mean volume above ``multiplier`` x the PRIOR baseline
    (D3: the reference folds the new value in first, so it never fires)."""
    return win.where(F.col("prior_baseline").isNotNull() & (F.col("prior_baseline") > 0) &
                     (F.col("avg_volume") > F.col("prior_baseline") * multiplier)).select(
        F.lit("VOLUME_ANOMALY").alias("rule"), F.lit("HIGH").alias("severity"),
        F.col("stock_code").cast("string").alias("key"), F.lit(None).cast("long").alias("event_id"),
        F.lit("volume above baseline").alias("detail"),
        F.col("window_start").alias("ts"))


def account_window_stats(tx: DataFrame, size: str) -> DataFrame:
    """ST6 / A10: per (account, tumbling window): count, sum, mean, max,
    distinct cities and types (``collect_set``: ``countDistinct`` is not
    allowed in streams), hour range and the latest transaction id."""
    agg = tx.groupBy("account", F.window("ts", size).alias("w")).agg(
        F.count(F.lit(1)).alias("tx_count"), F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"), F.max("amount").alias("max_amount"),
        F.collect_set("city").alias("_cities"), F.collect_set("type").alias("_types"),
        F.min(F.hour("ts")).alias("min_hour"), F.max(F.hour("ts")).alias("max_hour"),
        F.max_by("transaction_id", F.struct("ts", "transaction_id")).alias("latest_tx"))
    return agg.select("account", F.col("w.start").alias("window_start"), "tx_count", "total_amount", "avg_amount",
                      "max_amount", F.array_join(F.array_sort("_cities"), ",").alias("cities"),
                      F.size("_cities").alias("city_count"), "min_hour", "max_hour", "latest_tx",
                      F.array_join(F.array_sort("_types"), ",").alias("types"))


def rule_large_amount(tx: DataFrame, limit: float = LARGE_AMOUNT) -> DataFrame:
    """ST7: a single amount of at least ``limit``."""
    return tx.where(F.col("amount") >= limit).select(
        F.lit("LARGE_AMOUNT").alias("rule"), F.lit("HIGH").alias("severity"),
        F.col("account").cast("string").alias("key"), F.col("transaction_id").alias("event_id"),
        F.concat(F.lit("type "), F.col("type")).alias("detail"), F.col("ts"))


def rule_odd_hour(tx: DataFrame, hours=ODD_HOURS) -> DataFrame:
    """ST8: transaction between hours 0 and 5."""
    h = F.hour("ts")
    return tx.where(h.between(*hours)).select(
        F.lit("ABNORMAL_HOUR").alias("rule"), F.lit("MEDIUM").alias("severity"),
        F.col("account").cast("string").alias("key"), F.col("transaction_id").alias("event_id"),
        F.concat(F.lit("hour "), h.cast("string")).alias("detail"), F.col("ts"))


def rule_high_freq(stats: DataFrame, limit: int = HIGH_FREQ) -> DataFrame:
    """ST9: at least ``limit`` transactions in the window (D23: at least);
    one alert per (account, window) (D6)."""
    return stats.where(F.col("tx_count") >= limit).select(
        F.lit("HIGH_FREQUENCY").alias("rule"), F.lit("HIGH").alias("severity"),
        F.col("account").cast("string").alias("key"), F.col("latest_tx").alias("event_id"),
        F.concat(F.col("tx_count").cast("string"), F.lit(" tx")).alias("detail"), F.col("window_start").alias("ts"))


def rule_multi_city(stats: DataFrame, limit: int = MULTI_CITY) -> DataFrame:
    """ST10: at least ``limit`` distinct cities in the window."""
    return stats.where(F.col("city_count") >= limit).select(
        F.lit("MULTI_CITY").alias("rule"), F.lit("HIGH").alias("severity"),
        F.col("account").cast("string").alias("key"), F.col("latest_tx").alias("event_id"),
        F.concat(F.col("city_count").cast("string"), F.lit(" cities: "), F.col("cities")).alias("detail"),
        F.col("window_start").alias("ts"))


def behaviour_score() -> Column:
    """ST12: implicit feedback weight of one behaviour."""
    w = F.when(F.col("behavior") == "rate", F.col("rating") * RATE_FACTOR)
    for k, v in BEHAVIOUR_WEIGHT.items():
        w = w.when(F.col("behavior") == k, F.lit(v))
    return F.coalesce(w, F.lit(1.0))


def implicit_matrix(beh: DataFrame) -> DataFrame:
    """ST12: summed implicit score per (user, item); zeros are not stored."""
    return beh.groupBy("user_id", "item_id").agg(F.sum(behaviour_score()).alias("score"))


def item_category(item: Column) -> Column:
    cats = F.array(*[F.lit(c) for c in ITEM_CATEGORIES])
    return F.element_at(cats, (item % len(ITEM_CATEGORIES)).cast("int") + 1)


def latest_per_key(df: DataFrame, keys, ts: str, value_cols, tie: str | None = None) -> DataFrame:
    """The newest values per key (``max_by`` on the time, then ``tie``)."""
    order = F.struct(ts, tie) if tie else F.col(ts)
    return df.groupBy(*keys).agg(F.max(ts).alias("last_ts"),
                                 *[F.max_by(c, order).alias(c) for c in value_cols])
