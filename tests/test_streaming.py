"""Stream tests: several input files in order, restart from the checkpoint
after new input arrived, and the stream result equals the batch result."""

import datetime
import os

from pyspark.sql import functions as F

from conftest import SF001
from ledgerlake.operators import monitor as mo
from ledgerlake.plans.views import v_tx
from ledgerlake.streaming import jobs
from ledgerlake.streaming import runner as rn


def land(df, path, ts_col, n_files):
    """Files of consecutive event times, oldest first, as a folder fills up."""
    rows = df.orderBy(ts_col, *[c for c in df.columns if c != ts_col]).collect()
    step = -(-len(rows) // n_files)
    for i in range(0, len(rows), step):
        df.sparkSession.createDataFrame(rows[i:i + step], df.schema).coalesce(1).write.mode("append").parquet(path)


def _stats_query(spark, src, schema):
    s = rn.file_stream(spark, src, schema)
    return jobs._ntz(mo.account_window_stats(jobs._event_time(s), "1 day"), "window_start")


def test_restart_from_checkpoint_matches_batch(spark):
    tx = v_tx(spark, SF001)
    base = rn.run_dir(spark, "restart_test")
    local = base.replace("file:", "", 1)
    src, ck, sink = f"{base}/source", f"{base}/checkpoint", f"{base}/sink"
    cut = "2024-01-20 00:00:00"
    first = tx.where(F.col("ts") < F.lit(cut).cast("timestamp_ntz"))
    second = tx.where(F.col("ts") >= F.lit(cut).cast("timestamp_ntz"))
    with jobs.utc(spark):
        land(first, src, "ts", 3)
        rn.run(_stats_query(spark, src, tx.schema), ck, sink, "update")
        n_batches_1 = len([p for p in os.listdir(f"{local}/checkpoint/commits") if p.isdigit()])
        # new files land; the same query restarts from its checkpoint
        second.coalesce(1).write.mode("append").parquet(src)
        rn.run(_stats_query(spark, src, tx.schema), ck, sink, "update")
        n_batches_2 = len([p for p in os.listdir(f"{local}/checkpoint/commits") if p.isdigit()])
    assert n_batches_2 > n_batches_1
    # the resumed run only touched windows of the new file (no reprocessing)
    raw = spark.read.parquet(sink)
    first_max = n_batches_1 - 1
    resumed = raw.where(F.col("batch_id") > first_max)
    assert resumed.count() > 0
    assert resumed.where(F.col("window_start") < F.lit(cut).cast("timestamp_ntz")).count() == 0
    got = rn.read_latest(spark, sink, ["account", "window_start"])
    exp = mo.account_window_stats(tx, "1 day")
    cols = ["account", "window_start", "tx_count", "latest_tx", "cities", "city_count", "min_hour", "max_hour"]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in exp.select(*cols).collect())
    assert a == b
    ga = {(r.account, r.window_start): r.total_amount for r in got.collect()}
    gb = {(r.account, r.window_start): r.total_amount for r in exp.collect()}
    assert all(abs(ga[k] - gb[k]) < 1e-6 for k in gb)


def test_stateless_rules_stream_equals_batch(spark):
    tx = v_tx(spark, SF001)
    got = jobs.transaction_rules_stream(spark, v_tx(spark, SF001, rn.table_stream(spark, SF001, "events")))
    exp = mo.rule_large_amount(tx).unionByName(mo.rule_odd_hour(tx))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_rows_without_a_time_meet_the_amount_rule(spark):
    base = rn.run_dir(spark, "null_ts")
    schema = "transaction_id long, account long, amount double, city string, type string, ts timestamp_ntz"
    spark.createDataFrame([(1, 1, 1e6, "a", "t", None), (2, 1, 1.0, "a", "t", None)], schema).write.parquet(f"{base}/in")
    s = rn.file_stream(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema)
    assert [(r.rule, r.event_id) for r in jobs.transaction_rules_stream(spark, s).collect()] == [("LARGE_AMOUNT", 1)]


def _ticks(spark, rows):
    return spark.createDataFrame([(i, c, float(p), 1, datetime.datetime.fromisoformat(t)) for i, (c, p, t) in enumerate(rows)],
                                 "event_id long, stock_code string, price double, volume long, ts timestamp_ntz")


def test_late_update_renews_the_window_after_it(spark):
    """A row for day 1 arrives (within the watermark) after day 2 began."""
    base = rn.run_dir(spark, "late_change")
    parts = [[("a", 10, "2024-01-01T23:30:00"), ("b", 5, "2024-01-01T01:00:00")], [("a", 30, "2024-01-02T00:10:00")],
             [("a", 20, "2024-01-01T23:50:00")], [("a", 60, "2024-01-03T01:00:00"), ("b", 10, "2024-01-03T02:00:00")]]
    for p in parts:
        _ticks(spark, p).coalesce(1).write.mode("append").parquet(f"{base}/in")
    s = rn.file_stream(spark, f"{base}/in", _ticks(spark, parts[0]).schema)
    got = {(r.stock_code, r.window_start.day): (r.avg_price, r.change_pct) for r in jobs.price_change_stream(spark, s, "1 day").collect()}
    assert got == {("a", 1): (15.0, None), ("a", 2): (30.0, 100.0), ("a", 3): (60.0, 100.0), ("b", 1): (5.0, None),
                   ("b", 3): (10.0, 100.0)}


def test_rows_behind_the_watermark_are_counted_as_late(spark):
    base = rn.run_dir(spark, "late_rows")
    parts = [[("a", 1, "2024-01-01T00:10:00")], [("a", 1, "2024-01-05T00:00:00")], [("a", 1, "2024-01-05T03:00:00")],
             [("a", 1, "2024-01-01T00:20:00"), ("a", 1, "2024-01-05T03:10:00")]]
    for p in parts:
        _ticks(spark, p).coalesce(1).write.mode("append").parquet(f"{base}/in")
    s = rn.file_stream(spark, f"{base}/in", _ticks(spark, parts[0]).schema)
    r = jobs.late_data_stream(spark, s).first()
    assert (r.input_rows, r.counted_rows, r.late_rows) == (5, 4, 1)


def test_stream_of_an_empty_table(spark):
    base = rn.run_dir(spark, "empty")
    v_tx(spark, SF001).limit(0).write.parquet(f"{base}/in")
    s = rn.file_stream(spark, f"{base}/in", v_tx(spark, SF001).schema)
    assert jobs.transaction_rules_stream(spark, s).count() == 0
    assert jobs.account_stats_stream(spark, s, "1 day").count() == 0


def test_hot_topics_over_several_batches(spark):
    """Frames reach back into earlier batches through the state."""
    from ledgerlake.operators.text import analyse, hot_topics
    from ledgerlake.plans.text import DOC_LEXICON
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").where("doc_id < 40")
    base = rn.run_dir(spark, "topics")
    for lo in (0, 13, 15, 30):
        hi = {0: 13, 13: 15, 15: 30, 30: 40}[lo]
        docs.where(f"doc_id >= {lo} AND doc_id < {hi}").coalesce(1).write.mode("append").parquet(f"{base}/in")
    s = rn.file_stream(spark, f"{base}/in", docs.schema)
    got = jobs.hot_topics_stream(spark, s, DOC_LEXICON)
    want = hot_topics(analyse(docs, "text", DOC_LEXICON), ["doc_id"], 5, 10)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
