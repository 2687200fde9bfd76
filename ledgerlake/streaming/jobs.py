"""Structured Streaming jobs of the four monitoring cases (ST1-ST16).

Each job takes a streaming DataFrame (usually ``runner.table_stream`` under a
view), runs ``watermark -> window / rules -> sink`` to the end of the input and
returns the sink read back as a DataFrame.  Event time is the ``ts`` column
cast to TIMESTAMP under a UTC session zone (a watermark needs TIMESTAMP, not
TIMESTAMP_NTZ); window bounds go back to TIMESTAMP_NTZ before they are stored,
so the results do not depend on the reader's time zone.
"""

from __future__ import annotations

import contextlib
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import monitor as mo
from . import runner as rn

WATERMARK = "1 hour"


@contextlib.contextmanager
def utc(spark: SparkSession):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _event_time(s: DataFrame) -> DataFrame:
    return s.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", WATERMARK)


def _ntz(df: DataFrame, *cols) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def window_metrics_stream(spark: SparkSession, ticks: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """ST1: sliding-window tick metrics, update mode into an upsert sink."""
    with utc(spark):
        base = rn.run_dir(spark, "tick_metrics")
        q = _ntz(mo.tick_window_metrics(_event_time(ticks), size, slide), "window_start", "window_end")
        rn.run(q, f"{base}/checkpoint", f"{base}/sink", "update")
    return rn.read_latest(spark, f"{base}/sink", ["stock_code", "window_start"])


def account_stats_stream(spark: SparkSession, tx: DataFrame, size: str) -> DataFrame:
    """ST6: tumbling account statistics, update mode into an upsert sink."""
    with utc(spark):
        base = rn.run_dir(spark, "account_stats")
        q = _ntz(mo.account_window_stats(_event_time(tx), size), "window_start")
        rn.run(q, f"{base}/checkpoint", f"{base}/sink", "update")
    return rn.read_latest(spark, f"{base}/sink", ["account", "window_start"])


def transaction_rules_stream(spark: SparkSession, tx: DataFrame) -> DataFrame:
    """ST7 + ST8: stateless per-transaction rules, append mode; rows without a
    time still meet the rules that need none."""
    with utc(spark):
        base = rn.run_dir(spark, "tx_rules")
        s = tx.withColumn("ts", F.col("ts").cast("timestamp"))
        alerts = mo.rule_large_amount(s).unionByName(mo.rule_odd_hour(s))
        rn.run(_ntz(alerts, "ts"), f"{base}/checkpoint", f"{base}/sink", "append")
    return rn.read_appended(spark, f"{base}/sink")


def implicit_matrix_stream(spark: SparkSession, beh: DataFrame) -> DataFrame:
    """ST12: the user-item score matrix as a streaming aggregate (update mode)."""
    with utc(spark):
        base = rn.run_dir(spark, "implicit_matrix")
        rn.run(mo.implicit_matrix(beh), f"{base}/checkpoint", f"{base}/sink", "update")
    return rn.read_latest(spark, f"{base}/sink", ["user_id", "item_id"])


def sentiment_stream(spark: SparkSession, docs: DataFrame, lexicon) -> DataFrame:
    """ST15: the stateless tokenise -> score -> polarity topology over a
    stream of documents."""
    from ..operators.text import analyse
    with utc(spark):
        base = rn.run_dir(spark, "sentiment")
        out = analyse(docs, "text", lexicon).select("doc_id", "source", "positive_score", "negative_score",
                                                    "sentiment_score", "polarity")
        rn.run(out, f"{base}/checkpoint", f"{base}/sink", "append")
    return rn.read_appended(spark, f"{base}/sink")


def late_data_stream(spark: SparkSession, ticks: DataFrame, size: str = "1 hour") -> DataFrame:
    """ST16: rows that arrive behind the watermark are left out of their
    windows: rows read, rows the windows counted, and rows late (their
    difference), with the drops that the progress reports at the stateful
    operator (after partial aggregation)."""
    with utc(spark):
        base = rn.run_dir(spark, "late")
        q = _ntz(mo.tick_window_metrics(_event_time(ticks.where("ts IS NOT NULL")), size), "window_start", "window_end")
        query = rn.run(q, f"{base}/checkpoint", f"{base}/sink", "update")
        progress = [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]
        dropped = sum(int(op.get("numRowsDroppedByWatermark", 0) or 0)
                      for p in progress for op in p.get("stateOperators", []))
        rows_in = sum(int(p.get("numInputRows", 0)) for p in progress)
    counted = rn.read_latest(spark, f"{base}/sink", ["stock_code", "window_start"]).agg(F.sum("tick_count").alias("n"))
    n = F.coalesce("n", F.lit(0)).cast("long")
    return counted.select(F.lit(rows_in).cast("long").alias("input_rows"), n.alias("counted_rows"),
                          (F.lit(rows_in) - n).cast("long").alias("late_rows"),
                          F.lit(dropped).cast("long").alias("dropped_partial_rows"))


def price_change_stream(spark: SparkSession, ticks: DataFrame, size: str, open_windows: int = 3) -> DataFrame:
    """ST2 live: tumbling window means per code and the change of every window
    against the code's window before it.

    State between micro-batches is the newest ``open_windows`` windows of every
    code (those that the watermark may still let change, and one before them),
    never the history: a batch merges its updated windows into them and writes
    the changes of all merged windows again, so a late update also renews the
    window after it.  Batches write folders of their own and read the state
    of the batch before, so a replay changes nothing."""
    schema = "stock_code string, window_start timestamp_ntz, avg_price double, change_pct double"
    with utc(spark):
        base = rn.run_dir(spark, "price_change")
        q = _ntz(mo.tick_window_metrics(_event_time(ticks), size), "window_start", "window_end") \
            .select("stock_code", "window_start", "avg_price")

        def state(epoch_id: int) -> str:
            return f"{base}/state/{rn.BATCH}={epoch_id}"

        def write(batch: DataFrame, epoch_id: int) -> None:
            held = spark.read.schema(schema).parquet(state(epoch_id - 1))
            # The batch's version of a window replaces the state's.
            merged = held.withColumn("_new", F.lit(0)).unionByName(
                batch.withColumns({"change_pct": F.lit(None).cast("double"), "_new": F.lit(1)}))
            latest = merged.groupBy("stock_code", "window_start").agg(
                F.max_by(F.struct("avg_price", "change_pct"), "_new").alias("v")).select("stock_code", "window_start", "v.*")
            w = Window.partitionBy("stock_code").orderBy("window_start")
            prev = F.lag("avg_price").over(w)
            out = latest.withColumn("_prev", prev).withColumn(
                "change_pct", F.coalesce((F.col("avg_price") - F.col("_prev")) / F.col("_prev") * 100, "change_pct")).drop("_prev")
            rn.batch_sink(f"{base}/changes")(out, epoch_id)
            back = Window.partitionBy("stock_code").orderBy(F.desc("window_start"))
            stored = spark.read.schema(schema).parquet(f"{base}/changes/{rn.BATCH}={epoch_id}")
            stored.withColumn("_r", F.row_number().over(back)).where(F.col("_r") <= open_windows).drop("_r") \
                .write.mode("overwrite").parquet(state(epoch_id))

        empty = spark.createDataFrame([], schema)
        empty.write.mode("overwrite").parquet(state(-1))
        empty.write.mode("overwrite").parquet(f"{base}/changes/{rn.BATCH}=-1")
        rn.run(q, f"{base}/checkpoint", f"{base}/changes", "update", write=write)
    return rn.read_latest(spark, f"{base}/changes", ["stock_code", "window_start"])


def profile_stream(spark: SparkSession, beh: DataFrame) -> DataFrame:
    """ST13: live profiles, update mode: per user and interest (item category)
    the number of behaviours and the last time; sums over them give hot
    categories and a user's last activity."""
    with utc(spark):
        base = rn.run_dir(spark, "profiles")
        q = beh.groupBy("user_id", mo.item_category(F.col("item_id")).alias("category")).agg(
            F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_active"))
        rn.run(q, f"{base}/checkpoint", f"{base}/sink", "update")
    return rn.read_latest(spark, f"{base}/sink", ["user_id", "category"])


def hit_stream(spark: SparkSession, beh: DataFrame, lists: DataFrame) -> DataFrame:
    """ST14: live hits (user_id, hits) of purchases and ratings on the issued
    ``lists`` (user_id, item_id; static side of a stream-static join)."""
    with utc(spark):
        base = rn.run_dir(spark, "hits")
        q = (beh.where(F.col("behavior").isin("purchase", "rate")).join(lists, ["user_id", "item_id"])
             .groupBy("user_id").agg(F.count(F.lit(1)).alias("hits")))
        rn.run(q, f"{base}/checkpoint", f"{base}/sink", "update")
    return rn.read_latest(spark, f"{base}/sink", ["user_id"])


def hot_topics_stream(spark: SparkSession, docs: DataFrame, lexicon, window: int = 5, top: int = 10) -> DataFrame:
    """X4 in the stream: keyword and polarity counts over the last ``window``
    documents.  State between micro-batches is the last ``window - 1`` scored
    documents (in id order, as they arrive); a batch puts them before its own
    and writes the frames of its own documents."""
    from ..operators.text import analyse, hot_topics
    cols = ["doc_id", "sentiment_keywords", "sector_keywords", "polarity"]
    q = analyse(docs, "text", lexicon).select(*cols)
    with utc(spark):
        base = rn.run_dir(spark, "hot_topics")

        def state(epoch_id: int) -> str:
            return f"{base}/state/{rn.BATCH}={epoch_id}"

        def write(batch: DataFrame, epoch_id: int) -> None:
            rn.batch_sink(f"{base}/scored")(batch, epoch_id)       # the texts are scored once
            new = spark.read.schema(q.schema).parquet(f"{base}/scored/{rn.BATCH}={epoch_id}")
            held = spark.read.schema(q.schema).parquet(state(epoch_id - 1))
            both = held.unionByName(new)
            frames = hot_topics(both, ["doc_id"], window, top).join(new.select("doc_id"), "doc_id", "left_semi")
            rn.batch_sink(f"{base}/sink")(frames, epoch_id)
            both.orderBy(F.desc("doc_id")).limit(window - 1).write.mode("overwrite").parquet(state(epoch_id))

        empty = spark.createDataFrame([], q.schema)
        empty.write.mode("overwrite").parquet(state(-1))
        rn.batch_sink(f"{base}/sink")(hot_topics(empty, ["doc_id"], window, top), -1)
        rn.run(q, f"{base}/checkpoint", f"{base}/sink", "append", write=write)
    return rn.read_appended(spark, f"{base}/sink")
