"""Monitoring queries: ticks (ST1-ST5, S16, A5), transactions (ST6-ST11,
A6, A10, T2, E4, J6) and behaviours (ST12-ST14, S17, T4, J3-J5, B8).
``st_*`` queries run as Structured Streaming jobs; the oracle is the batch
result of the same rule."""

from __future__ import annotations

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ordered import ewm_multi, ewm_sql, materialize
from ..operators import monitor as mo
from ..operators import recommend as rc
from ..operators import similarity
from ..sources.tables import table
from ..streaming import jobs, state
from ..streaming.runner import table_stream
from .registry import register
from .text import DOC_LEXICON, HOT_TOPICS_SQL, S_SQL
from .views import V_BEHAVIOUR_SQL, V_TICK_SQL, V_TX_SQL, v_behaviour, v_tick, v_tx, with_ctes

DAY = "1 day"
TICK_DBL = ["avg_price", "max_price", "min_price", "volatility", "avg_volume"]


def _streamed(view, spark, sf_dir):
    """A view of the events table, read as a stream."""
    return view(spark, sf_dir, table_stream(spark, sf_dir, "events"))


def _r(df, cols, d=6):
    cols = set(cols)
    return df.select(*[F.round(F.col(c), d).alias(c) if c in cols else F.col(c) for c in df.columns])


def _tick_metrics_sql(bucket: str, size: str, digits: int | None = 6) -> str:
    r = (lambda e: f"round({e}, {digits})") if digits else (lambda e: e)
    return f"""SELECT stock_code, ws AS window_start, ws + INTERVAL {size} AS window_end,
  {r('avg(price)')} AS avg_price, {r('max(price)')} AS max_price, {r('min(price)')} AS min_price,
  {r('CASE WHEN avg(price) > 0 THEN stddev_pop(price) / avg(price) ELSE 0 END')} AS volatility,
  sum(volume) AS total_volume, {r('avg(volume)')} AS avg_volume, count(*) AS tick_count
FROM (SELECT *, {bucket} AS ws FROM t) GROUP BY stock_code, ws"""


_HALF = "date_trunc('day', ts) + CASE WHEN hour(ts) >= 12 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END"
SLIDING_SQL = _tick_metrics_sql(f"unnest([{_HALF}, {_HALF} - INTERVAL 12 HOUR])", "1 DAY")
DAILY_SQL = _tick_metrics_sql("date_trunc('day', ts)", "1 DAY", None)
HOURLY_SQL = _tick_metrics_sql("date_trunc('hour', ts)", "1 HOUR", None)
# ST5 check parameters: hourly windows and a 2x multiplier (the 5x default
# of the case never fires on these tables: the largest hourly ratio is ~3x).
VOLUME_CHECK_SIZE, VOLUME_CHECK_MULT = "1 hour", 2.0


@register("st_sliding_metrics", with_ctes(SLIDING_SQL, t=V_TICK_SQL))
def st_sliding_metrics(spark: SparkSession, sf_dir: str):
    """ST1: 1-day windows sliding by 12 hours, as a stream."""
    return _r(jobs.window_metrics_stream(spark, _streamed(v_tick, spark, sf_dir), DAY, "12 hours"), TICK_DBL)


def _daily(spark, sf_dir):
    return jobs.window_metrics_stream(spark, _streamed(v_tick, spark, sf_dir), DAY)


def _with_change(win):
    w = Window.partitionBy("stock_code").orderBy("window_start")
    prev = F.lag("avg_price").over(w)
    return win.withColumn("change_pct", (F.col("avg_price") - prev) / prev * 100)


def _with_baseline(win):
    out = ewm_multi(win, [("avg_volume", mo.BASELINE_ALPHA, "baseline")], ["window_start"], ["stock_code"])
    w = Window.partitionBy("stock_code").orderBy("window_start")
    return out.withColumn("prior_baseline", F.lag("baseline").over(w))


CHANGE_CTES = dict(
    t=V_TICK_SQL, d=DAILY_SQL,
    c="""SELECT *, (avg_price - lag(avg_price) OVER (PARTITION BY stock_code ORDER BY window_start))
            / lag(avg_price) OVER (PARTITION BY stock_code ORDER BY window_start) * 100 AS change_pct FROM d""",
    b=f"""SELECT *, lag(baseline) OVER (PARTITION BY stock_code ORDER BY window_start) AS prior_baseline
          FROM (SELECT *, {ewm_sql('avg_volume', mo.BASELINE_ALPHA, 'stock_code', 'window_start')} AS baseline FROM d)""",
    h=HOURLY_SQL,
    hb=f"""SELECT *, lag(baseline) OVER (PARTITION BY stock_code ORDER BY window_start) AS prior_baseline
          FROM (SELECT *, {ewm_sql('avg_volume', mo.BASELINE_ALPHA, 'stock_code', 'window_start')} AS baseline FROM h)""",
)


@register("st_price_change", with_ctes("SELECT stock_code, window_start, round(avg_price, 6) AS avg_price, "
                                       "round(change_pct, 6) AS change_pct FROM c",
                                       **CHANGE_CTES))
def st_price_change(spark, sf_dir):
    """ST2 live: change of the daily mean against the code's previous
    event-time window (unrounded, D5), computed inside the stream's
    ``foreachBatch`` against the windows already stored."""
    out = jobs.price_change_stream(spark, _streamed(v_tick, spark, sf_dir), DAY)
    return _r(out.select("stock_code", "window_start", "avg_price", "change_pct"), ["avg_price", "change_pct"])


@register("st_volume_baseline", with_ctes("SELECT stock_code, window_start, round(avg_volume, 6) AS avg_volume, "
                                          "round(baseline, 6) AS baseline, "
                                          "round(prior_baseline, 6) AS prior_baseline FROM b", **CHANGE_CTES))
def st_volume_baseline(spark, sf_dir):
    """ST3: b0 = v, b = 0.8 b + 0.2 v over the daily windows of every code."""
    out = _with_baseline(_daily(spark, sf_dir)).select("stock_code", "window_start", "avg_volume", "baseline",
                                                        "prior_baseline")
    return _r(out, ["avg_volume", "baseline", "prior_baseline"])


@register("st_volume_ema", with_ctes("SELECT stock_code, window_start, round(avg_price, 6) AS avg_price, round(change_pct, 6) AS change_pct, "
                                     "round(avg_volume, 6) AS avg_volume, round(baseline, 6) AS baseline, "
                                     "round(prior_baseline, 6) AS prior_baseline FROM b JOIN c USING (stock_code, window_start, avg_price, avg_volume)",
                                     **CHANGE_CTES))
def st_volume_ema(spark, sf_dir):
    """ST2 + ST3 live: change and volume baseline of the daily windows from
    keyed state, a few files a micro-batch."""
    out = state.tick_baseline_stream(spark, v_tick(spark, sf_dir, table_stream(spark, sf_dir, "events", max_files=4)), DAY)
    cols = ["avg_price", "change_pct", "avg_volume", "baseline", "prior_baseline"]
    return _r(out.select("stock_code", "window_start", *cols), cols)


ALERT_SQL_COLS = "rule, severity, key, event_id, detail, ts"
SURGE_SQL = f"""SELECT 'PRICE_SURGE' AS rule, CASE WHEN abs(change_pct) > {2 * mo.PRICE_CHANGE_PCT} THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
  stock_code AS key, CAST(NULL AS BIGINT) AS event_id, CASE WHEN change_pct > 0 THEN 'up' ELSE 'down' END AS detail,
  window_start AS ts FROM c WHERE abs(change_pct) > {mo.PRICE_CHANGE_PCT}"""
VOLUME_SQL = f"""SELECT 'VOLUME_ANOMALY' AS rule, 'HIGH' AS severity, stock_code AS key, CAST(NULL AS BIGINT) AS event_id,
  'volume above baseline' AS detail, window_start AS ts FROM hb
  WHERE prior_baseline > 0 AND avg_volume > prior_baseline * {VOLUME_CHECK_MULT}"""


@register("alert_price_surge", with_ctes(SURGE_SQL, **CHANGE_CTES))
def alert_price_surge(spark, sf_dir):
    """ST4: daily change above 3% (HIGH above 6%)."""
    return mo.price_surge_alerts(_with_change(_daily(spark, sf_dir)))


def _hourly_volume_alerts(spark, sf_dir):
    win = jobs.window_metrics_stream(spark, _streamed(v_tick, spark, sf_dir), VOLUME_CHECK_SIZE)
    return mo.volume_alerts(_with_baseline(win), VOLUME_CHECK_MULT)


@register("alert_volume", with_ctes(VOLUME_SQL, **CHANGE_CTES))
def alert_volume(spark, sf_dir):
    """ST5: hourly mean volume above 2x the PRIOR baseline (streamed windows)."""
    return _hourly_volume_alerts(spark, sf_dir)


@register("alerts_by_type", with_ctes(f"SELECT rule, count(*) AS alerts FROM ({SURGE_SQL} UNION ALL {VOLUME_SQL}) "
                                      "GROUP BY rule", **CHANGE_CTES))
def alerts_by_type(spark, sf_dir):
    """A5: alert counts by type."""
    d = _daily(spark, sf_dir)
    alerts = mo.price_surge_alerts(_with_change(d)).unionByName(_hourly_volume_alerts(spark, sf_dir))
    return alerts.groupBy("rule").agg(F.count(F.lit(1)).alias("alerts"))


@register("latest_per_key", with_ctes("""SELECT stock_code, max(ts) AS last_ts,
  arg_max(price, {'t': ts, 'k': event_id}) AS price, arg_max(volume, {'t': ts, 'k': event_id}) AS volume
FROM t GROUP BY stock_code""", t=V_TICK_SQL))
def latest_per_key(spark, sf_dir):
    """Latest metrics per key (the hash upsert, batch form)."""
    return mo.latest_per_key(v_tick(spark, sf_dir), ["stock_code"], "ts", ["price", "volume"], tie="event_id")


# ------------------------------------------------------------ transactions
STATS_SQL = """SELECT account, date_trunc('day', ts) AS window_start, count(*) AS tx_count,
  sum(amount) AS total_amount, avg(amount) AS avg_amount, max(amount) AS max_amount,
  array_to_string(list_sort(list_distinct(list(city))), ',') AS cities,
  CAST(len(list_distinct(list(city))) AS INTEGER) AS city_count,
  CAST(min(hour(ts)) AS INTEGER) AS min_hour, CAST(max(hour(ts)) AS INTEGER) AS max_hour,
  arg_max(transaction_id, {'t': ts, 'k': transaction_id}) AS latest_tx,
  array_to_string(list_sort(list_distinct(list(type))), ',') AS types
FROM x GROUP BY account, date_trunc('day', ts)"""
STAT_DBL = ["total_amount", "avg_amount", "max_amount"]


def _stats(spark, sf_dir):
    return jobs.account_stats_stream(spark, _streamed(v_tx, spark, sf_dir), DAY)


@register("st_tumbling_stats", with_ctes("SELECT account, window_start, tx_count, round(total_amount, 6) AS total_amount, "
                                         "round(avg_amount, 6) AS avg_amount, round(max_amount, 6) AS max_amount, cities, "
                                         "city_count, min_hour, max_hour, latest_tx, types FROM s",
                                         x=V_TX_SQL, s=STATS_SQL))
def st_tumbling_stats(spark, sf_dir):
    """ST6: 1-day tumbling account statistics as a stream."""
    return _r(_stats(spark, sf_dir), STAT_DBL)


LARGE_SQL = f"""SELECT 'LARGE_AMOUNT' AS rule, 'HIGH' AS severity, CAST(account AS VARCHAR) AS key,
  transaction_id AS event_id, 'type ' || type AS detail, ts FROM x WHERE amount >= {mo.LARGE_AMOUNT}"""
ODD_SQL = f"""SELECT 'ABNORMAL_HOUR' AS rule, 'MEDIUM' AS severity, CAST(account AS VARCHAR) AS key,
  transaction_id AS event_id, 'hour ' || CAST(hour(ts) AS VARCHAR) AS detail, ts FROM x
  WHERE hour(ts) BETWEEN {mo.ODD_HOURS[0]} AND {mo.ODD_HOURS[1]}"""
FREQ_SQL = f"""SELECT 'HIGH_FREQUENCY' AS rule, 'HIGH' AS severity, CAST(account AS VARCHAR) AS key,
  latest_tx AS event_id, CAST(tx_count AS VARCHAR) || ' tx' AS detail, window_start AS ts FROM s
  WHERE tx_count >= {mo.HIGH_FREQ}"""
CITY_SQL = f"""SELECT 'MULTI_CITY' AS rule, 'HIGH' AS severity, CAST(account AS VARCHAR) AS key,
  latest_tx AS event_id, CAST(city_count AS VARCHAR) || ' cities: ' || cities AS detail, window_start AS ts FROM s
  WHERE city_count >= {mo.MULTI_CITY}"""
TX_CTES = dict(x=V_TX_SQL, s=STATS_SQL)


def _rules(spark, sf_dir):
    return jobs.transaction_rules_stream(spark, _streamed(v_tx, spark, sf_dir))


@register("rule_large_amount", with_ctes(LARGE_SQL, **TX_CTES))
def rule_large_amount(spark, sf_dir):
    """ST7 as a stream (stateless, append)."""
    return _rules(spark, sf_dir).where(F.col("rule") == "LARGE_AMOUNT")


@register("rule_odd_hour", with_ctes(ODD_SQL, **TX_CTES))
def rule_odd_hour(spark, sf_dir):
    """ST8 as a stream (stateless, append)."""
    return _rules(spark, sf_dir).where(F.col("rule") == "ABNORMAL_HOUR")


@register("rule_high_freq", with_ctes(FREQ_SQL, **TX_CTES))
def rule_high_freq(spark, sf_dir):
    """ST9 on the streamed 1-day account windows."""
    return mo.rule_high_freq(_stats(spark, sf_dir))


@register("rule_multi_city", with_ctes(CITY_SQL, **TX_CTES))
def rule_multi_city(spark, sf_dir):
    """ST10 on the streamed 1-day account windows."""
    return mo.rule_multi_city(_stats(spark, sf_dir))


UNION_SQL = f"{LARGE_SQL} UNION ALL {ODD_SQL} UNION ALL {FREQ_SQL} UNION ALL {CITY_SQL}"


@register("union_alerts", with_ctes(UNION_SQL, **TX_CTES))
def union_alerts(spark, sf_dir):
    """ST11 / J6: all rules in one alert schema (unionByName)."""
    stats = _stats(spark, sf_dir)
    return _rules(spark, sf_dir).unionByName(mo.rule_high_freq(stats)).unionByName(mo.rule_multi_city(stats))


@register("anomaly_summary", with_ctes(f"""SELECT rule, count(*) AS alerts,
  round(count(*) * 1.0 / (SELECT count(*) FROM x), 6) AS alert_rate FROM ({UNION_SQL}) GROUP BY rule""", **TX_CTES))
def anomaly_summary(spark, sf_dir):
    """Alerts per rule and the rate per transaction (batch rules)."""
    tx = v_tx(spark, sf_dir)
    stats = mo.account_window_stats(tx, DAY)
    alerts = (mo.rule_large_amount(tx).unionByName(mo.rule_odd_hour(tx))
              .unionByName(mo.rule_high_freq(stats)).unionByName(mo.rule_multi_city(stats)))
    n = tx.agg(F.count(F.lit(1)).alias("n"))
    return alerts.groupBy("rule").agg(F.count(F.lit(1)).alias("alerts")).crossJoin(F.broadcast(n)) \
                 .select("rule", "alerts", F.round(F.col("alerts") / F.col("n"), 6).alias("alert_rate"))


@register("top_accounts", with_ctes("""SELECT * FROM (SELECT 'tx_count' AS ranking, CAST(account AS VARCHAR) AS key, count(*) AS n
  FROM x GROUP BY account ORDER BY n DESC, account LIMIT 3)
UNION ALL SELECT * FROM (SELECT 'anomalies' AS ranking, key, count(*) AS n FROM (""" + UNION_SQL + """)
  GROUP BY key ORDER BY n DESC, key LIMIT 5)""", **TX_CTES))
def top_accounts(spark, sf_dir):
    """Top 3 accounts by transactions and top 5 by anomalies
    (TakeOrderedAndProject: a k-row heap per partition)."""
    tx = v_tx(spark, sf_dir)
    stats = mo.account_window_stats(tx, DAY)
    alerts = (mo.rule_large_amount(tx).unionByName(mo.rule_odd_hour(tx))
              .unionByName(mo.rule_high_freq(stats)).unionByName(mo.rule_multi_city(stats)))
    by_tx = (tx.groupBy("account").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "account").limit(3)
               .select(F.lit("tx_count").alias("ranking"), F.col("account").cast("string").alias("key"), "n"))
    by_alert = (alerts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "key").limit(5)
                  .select(F.lit("anomalies").alias("ranking"), "key", "n"))
    return by_tx.unionByName(by_alert)


@register("account_stats", with_ctes("""SELECT account, count(*) AS tx_count, CAST(count(DISTINCT city) AS BIGINT) AS city_count,
  CAST(count(DISTINCT type) AS BIGINT) AS type_count, CAST(min(hour(ts)) AS INTEGER) AS min_hour,
  CAST(max(hour(ts)) AS INTEGER) AS max_hour, arg_max(transaction_id, {'t': ts, 'k': transaction_id}) AS last_id
FROM x GROUP BY account""", x=V_TX_SQL))
def account_stats(spark, sf_dir):
    """A10 (batch): distinct cities and types, hour range, last id."""
    tx = v_tx(spark, sf_dir)
    return tx.groupBy("account").agg(
        F.count(F.lit(1)).alias("tx_count"), F.count_distinct("city").alias("city_count"),
        F.count_distinct("type").alias("type_count"), F.min(F.hour("ts")).alias("min_hour"),
        F.max(F.hour("ts")).alias("max_hour"), F.max_by("transaction_id", F.struct("ts", "transaction_id")).alias("last_id"))


@register("abnormal_hour", """SELECT event_id, CAST(hour(CAST(CAST(ts AS VARCHAR) AS TIMESTAMP)) AS INTEGER) AS hour,
  CAST(hour(CAST(CAST(ts AS VARCHAR) AS TIMESTAMP)) BETWEEN 0 AND 5 AS BOOLEAN) AS abnormal FROM events""")
def abnormal_hour(spark, sf_dir):
    """Parse the text timestamp, take its hour, flag hours 0-5."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("ts_text"))
    h = F.hour(F.try_to_timestamp("ts_text"))
    return e.select("event_id", h.alias("hour"), h.between(*mo.ODD_HOURS).alias("abnormal"))


# -------------------------------------------------------------- behaviours
BEH_SCORE_SQL = ("CASE WHEN behavior = 'rate' THEN rating * 1.5 WHEN behavior = 'browse' THEN 1.0 "
                 "WHEN behavior = 'click' THEN 2.0 WHEN behavior = 'purchase' THEN 5.0 ELSE 1.0 END")
CAT_SQL = "list_extract(['programming', 'ai', 'math', 'ops'], CAST(item_id % 4 AS INTEGER) + 1)"
MATRIX_SQL = f"SELECT user_id, item_id, sum({BEH_SCORE_SQL}) AS score FROM bh GROUP BY user_id, item_id"
BEH_CTES = dict(bh=V_BEHAVIOUR_SQL, m=MATRIX_SQL)


@register("implicit_matrix", with_ctes("SELECT user_id, item_id, round(score, 6) AS score FROM m", **BEH_CTES))
def implicit_matrix(spark, sf_dir):
    """ST12: the implicit feedback matrix as a streaming aggregate."""
    return _r(jobs.implicit_matrix_stream(spark, _streamed(v_behaviour, spark, sf_dir)), ["score"])


def item_dim(beh):
    """Item dimension (id -> name, category) of all items in the data."""
    return beh.select("item_id").distinct().select("item_id", F.format_string("ITEM%03d", F.col("item_id")).alias("name"),
                                                   mo.item_category(F.col("item_id")).alias("category"))


@register("interest_by_category", with_ctes(f"SELECT {CAT_SQL} AS category, count(*) AS events, "
                                            "CAST(count(DISTINCT user_id) AS BIGINT) AS users FROM bh GROUP BY 1", **BEH_CTES))
def interest_by_category(spark, sf_dir):
    """Every behaviour looks up its item's category; a left join keeps
    behaviours whose item is unknown, and Spark picks the join by size."""
    b = v_behaviour(spark, sf_dir)
    b = b.join(item_dim(b), "item_id", "left")
    return b.groupBy("category").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"))


@register("hot_items_topn", with_ctes("SELECT item_id, count(*) AS hits FROM bh GROUP BY item_id ORDER BY hits DESC, "
                                      "item_id LIMIT 10", **BEH_CTES))
def hot_items_topn(spark, sf_dir):
    """S17 / ST13: sorted-set counters, top 10 items."""
    b = v_behaviour(spark, sf_dir)
    return b.groupBy("item_id").agg(F.count(F.lit(1)).alias("hits")).orderBy(F.desc("hits"), "item_id").limit(10)


@register("st_hot_items", with_ctes("SELECT item_id, count(*) AS hits FROM bh GROUP BY item_id ORDER BY hits DESC, "
                                    "item_id LIMIT 10", **BEH_CTES))
def st_hot_items(spark, sf_dir):
    """S17 / ST13 live: a bounded summary of the stream names the candidates, a
    second pass counts them."""
    return state.hot_items_stream(spark, _streamed(v_behaviour, spark, sf_dir), "item_id", v_behaviour(spark, sf_dir))


@register("user_top_interests", with_ctes(f"""SELECT user_id, category, n, CAST(r AS INTEGER) AS rank FROM (
  SELECT user_id, category, n, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category) AS r FROM (
    SELECT user_id, {CAT_SQL} AS category, count(*) AS n FROM bh GROUP BY 1, 2)) WHERE r <= 3""", **BEH_CTES))
def user_top_interests(spark, sf_dir):
    """T4: top 3 categories per user (aggregate first, so a user's window
    holds at most one row per category)."""
    b = v_behaviour(spark, sf_dir)
    b = b.join(item_dim(b), "item_id", "left")
    g = b.groupBy("user_id", "category").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("user_id").orderBy(F.desc("n"), "category")
    return g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 3)


SIM_SQL = """SELECT a.user_id AS user_a, b.user_id AS user_b,
  sum(a.score * b.score) / (max(na.norm) * max(nb.norm)) AS similarity
FROM m a JOIN m b ON a.item_id = b.item_id AND a.user_id <> b.user_id
JOIN (SELECT user_id, sqrt(sum(score * score)) AS norm FROM m GROUP BY user_id) na ON na.user_id = a.user_id
JOIN (SELECT user_id, sqrt(sum(score * score)) AS norm FROM m GROUP BY user_id) nb ON nb.user_id = b.user_id
GROUP BY a.user_id, b.user_id"""


CF_NEIGHBOURS = 20


@register("cf_similarity", with_ctes(f"""SELECT user_a, user_b, round(similarity, 6) AS similarity, CAST(k AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_a ORDER BY similarity DESC, user_b) AS k FROM s WHERE similarity > 0)
  WHERE k <= {CF_NEIGHBOURS}""", **BEH_CTES, s=SIM_SQL))
def cf_similarity(spark, sf_dir):
    """J4 / B1 (live): the nearest users of every user by cosine over common
    items of the implicit matrix (blocked products, no row per pair)."""
    m = mo.implicit_matrix(v_behaviour(spark, sf_dir))
    nb = rc.block_neighbours(m, "user_id", "item_id", "score", CF_NEIGHBOURS)
    return nb.select(F.col("a").alias("user_a"), F.col("b").alias("user_b"), F.round("similarity", 6).alias("similarity"),
                     F.col("k").alias("rank"))


@register("cf_similarity_sparse", with_ctes(f"""SELECT user_a, user_b, round(similarity, 6) AS similarity, CAST(k AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_a ORDER BY similarity DESC, user_b) AS k FROM s WHERE similarity > 0)
  WHERE k <= {CF_NEIGHBOURS}""", **BEH_CTES, s=SIM_SQL))
def cf_similarity_sparse(spark, sf_dir):
    """B1 for sparse data: the same neighbours through an inverted index with
    prefix filtering; users that share no item of a prefix never meet."""
    m = mo.implicit_matrix(v_behaviour(spark, sf_dir))
    nb = similarity.nearest(m, "user_id", "item_id", "score", CF_NEIGHBOURS)
    return nb.select(F.col("a").alias("user_a"), F.col("b").alias("user_b"), F.round("similarity", 6).alias("similarity"),
                     F.col("k").alias("rank"))


@register("cf_recommend", with_ctes("""SELECT user_id, item_id, round(score, 2) AS score, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS r FROM (
    SELECT t.user_a AS user_id, m.item_id, sum(m.score * t.similarity) AS score
    FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_a ORDER BY similarity DESC, user_b) AS k
                         FROM s WHERE similarity > 0) WHERE k <= 5) t
    JOIN m ON m.user_id = t.user_b
    WHERE NOT EXISTS (SELECT 1 FROM m seen WHERE seen.user_id = t.user_a AND seen.item_id = m.item_id)
    GROUP BY t.user_a, m.item_id)) WHERE r <= 5""", **BEH_CTES, s=SIM_SQL))
def cf_recommend(spark, sf_dir):
    """B8 + J5: top 5 similar users (similarity > 0), their items the user
    has not touched (left anti join), weighted sum, top 5 per user."""
    m = mo.implicit_matrix(v_behaviour(spark, sf_dir))
    return rc.neighbour_recommend(m, "user_id", "item_id", "score", k_users=5, top_n=5, digits=2)


CUT = "2024-01-25 00:00:00"


HIT_RATE_SQL = with_ctes(f"""SELECT lists, hits, round(hits * 1.0 / lists, 6) AS hit_rate FROM
  (SELECT count(DISTINCT user_id) AS lists FROM bh WHERE ts < TIMESTAMP '{CUT}') l,
  (SELECT count(*) AS hits FROM bh e JOIN recs ON recs.user_id = e.user_id AND recs.item_id = e.item_id
   WHERE e.ts >= TIMESTAMP '{CUT}' AND e.behavior IN ('purchase', 'rate')) h""",
    bh=V_BEHAVIOUR_SQL,
    m=f"SELECT user_id, item_id, sum({BEH_SCORE_SQL}) AS score FROM bh WHERE ts < TIMESTAMP '{CUT}' GROUP BY 1, 2",
    s=SIM_SQL,
    recs="""SELECT user_id, item_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS r FROM (
    SELECT t.user_a AS user_id, m.item_id, sum(m.score * t.similarity) AS score
    FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_a ORDER BY similarity DESC, user_b) AS k
                         FROM s WHERE similarity > 0) WHERE k <= 5) t
    JOIN m ON m.user_id = t.user_b
    WHERE NOT EXISTS (SELECT 1 FROM m seen WHERE seen.user_id = t.user_a AND seen.item_id = m.item_id)
    GROUP BY t.user_a, m.item_id)) WHERE r <= 5""")


@register("rec_hit_rate", HIT_RATE_SQL)
def rec_hit_rate(spark, sf_dir):
    """ST14 (batch form): lists from behaviours before the cut, hits =
    later purchases / ratings of a listed item (left semi on the lists),
    rate = hits / lists issued (one per user active before the cut, D21)."""
    b = v_behaviour(spark, sf_dir)
    before = b.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    after = b.where((F.col("ts") >= F.lit(CUT).cast("timestamp_ntz")) & F.col("behavior").isin("purchase", "rate"))
    recs = rc.neighbour_recommend(mo.implicit_matrix(before), "user_id", "item_id", "score", 5, 5)
    hits = after.join(recs.select("user_id", "item_id"), ["user_id", "item_id"], "left_semi")
    lists = before.agg(F.count_distinct("user_id").alias("lists"))
    h = hits.agg(F.count(F.lit(1)).alias("hits"))
    return lists.crossJoin(h).select("lists", "hits", F.round(F.col("hits") / F.col("lists"), 6).alias("hit_rate"))


@register("st_sentiment", with_ctes("SELECT doc_id, source, positive_score, negative_score, sentiment_score, polarity FROM s",
                                    s=S_SQL))
def st_sentiment(spark, sf_dir):
    """ST15: the sentiment topology over a document stream."""
    d = table_stream(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return jobs.sentiment_stream(spark, d, DOC_LEXICON)


@register("st_profiles", with_ctes(f"SELECT user_id, {CAT_SQL} AS category, count(*) AS n, max(ts) AS last_active FROM bh GROUP BY 1, 2",
                                   **BEH_CTES))
def st_profiles(spark, sf_dir):
    """ST13: interests and last activity per user as a stream."""
    return jobs.profile_stream(spark, _streamed(v_behaviour, spark, sf_dir))


@register("st_hot_categories", with_ctes(f"""SELECT {CAT_SQL} AS category, count(*) AS hits, count(DISTINCT user_id) AS users,
  max(ts) AS last_active FROM bh GROUP BY 1""", **BEH_CTES))
def st_hot_categories(spark, sf_dir):
    """ST13: hot categories from the streamed profiles."""
    p = jobs.profile_stream(spark, _streamed(v_behaviour, spark, sf_dir))
    return p.groupBy("category").agg(F.sum("n").alias("hits"), F.count(F.lit(1)).alias("users"), F.max("last_active").alias("last_active"))


@register("st_hit_rate", HIT_RATE_SQL)
def st_hit_rate(spark, sf_dir):
    """ST14: lists issued from the behaviours before the cut, hits counted
    per user in the stream of the later ones."""
    before = v_behaviour(spark, sf_dir).where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    recs = materialize(rc.neighbour_recommend(mo.implicit_matrix(before), "user_id", "item_id", "score", 5, 5)
                       .select("user_id", "item_id"))
    later = _streamed(v_behaviour, spark, sf_dir).where(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"))
    hits = jobs.hit_stream(spark, later, recs).agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("hits"))
    lists = before.agg(F.count_distinct("user_id").alias("lists"))
    return lists.crossJoin(hits).select("lists", "hits", F.round(F.col("hits") / F.col("lists"), 6).alias("hit_rate"))


@register("st_hot_topics", HOT_TOPICS_SQL)
def st_hot_topics(spark, sf_dir):
    """ST15 / X4: hot topics over the last documents of the stream."""
    d = table_stream(spark, sf_dir, "documents").select("doc_id", "text")
    out = jobs.hot_topics_stream(spark, d, DOC_LEXICON)
    return out.select("doc_id", "docs_in_window", "positive_docs", "negative_docs", "neutral_docs", "top_keywords")


@register("st_late_data", with_ctes("""SELECT count(*) AS input_rows, count(*) AS counted_rows, 0::BIGINT AS late_rows,
  0::BIGINT AS dropped_partial_rows FROM t""", t=V_TICK_SQL))
def st_late_data(spark, sf_dir):
    """ST16 over the given table: all its files are one micro-batch, so no
    row is behind the watermark (files that arrive late are in the tests)."""
    return jobs.late_data_stream(spark, _streamed(v_tick, spark, sf_dir))
