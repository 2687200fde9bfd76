"""Keyed state in streams: equal to the batch result over several micro-batches,
across a restart, with late rows, and dropped for silent keys."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from ledgerlake.functions.ordered import ewm_multi
from ledgerlake.operators import monitor as mo
from ledgerlake.plans.views import v_tick
from ledgerlake.sources.tables import table
from ledgerlake.streaming import runner as rn
from ledgerlake.streaming import state
from ledgerlake.streaming.jobs import utc
from test_streaming import land


def batch_baselines(ticks, size="1 day"):
    win = mo.tick_window_metrics(ticks, size)
    w = Window.partitionBy("stock_code").orderBy("window_start")
    out = ewm_multi(win, [("avg_volume", mo.BASELINE_ALPHA, "baseline")], ["window_start"], ["stock_code"])
    prev = F.lag("avg_price").over(w)
    return out.withColumns({"prior_baseline": F.lag("baseline").over(w), "change_pct": (F.col("avg_price") - prev) / prev * 100})


def rounded(df):
    cols = ["avg_price", "change_pct", "avg_volume", "baseline", "prior_baseline"]
    return sorted((r.stock_code, str(r.window_start), *[None if r[c] is None else round(r[c], 6) for c in cols]) for r in df.collect())


def run_baselines(spark, base, schema, **options):
    with utc(spark), state.rocksdb(spark):
        src = rn.file_stream(spark, f"{base}/source", schema, 1)
        rn.run(state.tick_baselines(src, "1 day", **options), f"{base}/checkpoint", f"{base}/sink", "update")
    return rn.read_latest(spark, f"{base}/sink", ["stock_code", "window_start"])


def test_baselines_over_files_and_a_restart(spark):
    ticks = v_tick(spark, SF001)
    base = rn.run_dir(spark, "baseline_test")
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    with utc(spark):
        land(ticks.where(F.col("ts") < cut), f"{base}/source", "ts", 3)
        run_baselines(spark, base, ticks.schema)
        done = len([p for p in os.listdir(f"{base.replace('file:', '', 1)}/checkpoint/commits") if p.isdigit()])
        ticks.where(F.col("ts") >= cut).coalesce(1).write.mode("append").parquet(f"{base}/source")
        got = run_baselines(spark, base, ticks.schema)
        assert rounded(got) == rounded(batch_baselines(ticks))
    # The second run wrote the windows from the cut on and those still open, not the history.
    second = spark.read.parquet(f"{base}/sink").where(F.col(rn.BATCH) >= done)
    assert second.agg(F.min("window_start")).first()[0] >= dt.datetime(2024, 1, 19)


def tick_rows(spark, rows):
    return spark.createDataFrame([(i, c, p, v, dt.datetime.fromisoformat(t)) for i, (c, p, v, t) in enumerate(rows)],
                                 "event_id long, stock_code string, price double, volume long, ts timestamp_ntz")


def test_late_rows_renew_their_window_and_those_after_it(spark):
    base = rn.run_dir(spark, "late_baselines")
    files = [[("a", 10.0, 100, "2024-01-01 10:00"), ("a", 20.0, 200, "2024-01-02 00:10"), ("b", 1.0, 1, "2024-01-02 00:20")],
             [("a", 30.0, 300, "2024-01-01 23:50"), ("a", None, None, "2024-01-02 00:30")],       # an hour late at most
             [("a", 40.0, 400, "2024-01-05 12:00"), (None, 1.0, 1, "2024-01-05 12:00")],
             [("a", 99.0, 999, "2024-01-01 12:00"), ("a", 50.0, 500, "2024-01-06 12:00")]]           # the first is too late
    for f in files:
        tick_rows(spark, f).coalesce(1).write.mode("append").parquet(f"{base}/source")
    with utc(spark):
        got = run_baselines(spark, base, tick_rows(spark, files[0]).schema)
        kept = tick_rows(spark, files[0] + files[1] + files[2][:1] + files[3][1:])
        assert rounded(got) == rounded(batch_baselines(kept))


def test_silent_keys_are_dropped(spark):
    base = rn.run_dir(spark, "silent")
    day = "2024-01-{:02d} 12:00"
    files = [[("quiet", 1.0, 100, day.format(1)), ("busy", 1.0, 10, day.format(1))]]
    files += [[("busy", 1.0, 10 * d, day.format(d))] for d in range(2, 9)] + [[("quiet", 2.0, 500, day.format(9))]]
    for f in files:
        tick_rows(spark, f).coalesce(1).write.mode("append").parquet(f"{base}/source")
    with utc(spark):
        got = run_baselines(spark, base, tick_rows(spark, files[0]).schema, idle_ms=3 * 86_400_000)
        last = {r.stock_code: r for r in got.where("window_start >= '2024-01-08'").collect()}
    assert last["quiet"].baseline == 500 and last["quiet"].prior_baseline is None and last["quiet"].change_pct is None
    assert last["busy"].prior_baseline is not None


def test_last_n_over_files_and_a_restart(spark):
    events = table(spark, SF001, "events").select("event_id", "user_id", "ts", "value")
    rows = events.collect()
    random.Random(3).shuffle(rows)               # any order: the newest stay
    extra = [(-1, None, rows[0].ts, 1.0), (-2, 5, None, 1.0), (900_000, 7, max(r.ts for r in rows), None)]
    all_rows = [tuple(r) for r in rows] + extra
    base = rn.run_dir(spark, "last_n_test")

    def run():
        with utc(spark), state.rocksdb(spark):
            src = rn.file_stream(spark, f"{base}/source", events.schema, 1)
            rn.run(state.last_n(src, "user_id", "ts", "event_id", ["event_id", "ts", "value"], 4, watermark="1000 days"),
                   f"{base}/checkpoint", f"{base}/sink", "update")

    step = -(-len(all_rows) // 4)
    for k in range(4):
        if k == 2:
            run()
        spark.createDataFrame(all_rows[k * step:(k + 1) * step], events.schema).coalesce(2).write.mode("append").parquet(f"{base}/source")
    run()
    with utc(spark):
        got = rn.read_latest(spark, f"{base}/sink", ["_key"]).select("_key", F.inline("last")).collect()
    want = set()
    for u in {r[1] for r in all_rows} - {None}:
        mine = sorted((r for r in all_rows if r[1] == u and r[2] is not None), key=lambda r: (r[2], r[0]), reverse=True)[:4]
        want |= {(u, r[0], r[3]) for r in mine}
    assert {(r["_key"], r.event_id, r.value) for r in got} == want


@pytest.mark.parametrize("capacity", [4, 12, 1000])
def test_hot_items_with_bounded_state(spark, capacity):
    rng = random.Random(8)
    items = [min(int(rng.paretovariate(0.7)), 400) for _ in range(4000)] + [None] * 50
    df = spark.createDataFrame([(i,) for i in items], "item long")
    base = rn.run_dir(spark, "hot_test")
    for part in df.randomSplit([1.0] * 4, 1):
        part.coalesce(1).write.mode("append").parquet(f"{base}/source")
    src = rn.file_stream(spark, f"{base}/source", df.schema, 1)
    got = [tuple(r) for r in state.hot_items_stream(spark, src, "item", spark.read.parquet(f"{base}/source"), 3, capacity).collect()]
    known = [i for i in items if i is not None]
    want = sorted(((i, known.count(i)) for i in set(known)), key=lambda x: (-x[1], x[0]))[:3]
    assert got == want


def test_counters_bound_the_error(spark):
    rng = random.Random(9)
    parts = [[rng.choice("abcdefgh") if rng.random() < 0.5 else str(rng.randrange(300)) for _ in range(500)] for _ in range(4)]
    held = spark.createDataFrame([], "member string, n long, lost long")
    for p in parts:
        new = spark.createDataFrame([(x,) for x in p], "member string").groupBy("member").agg(F.count(F.lit(1)).alias("n"))
        held = spark.createDataFrame(state.merge_counters(held.unionByName(new.withColumn("lost", F.lit(0).cast("long"))), 20).collect(), held.schema)
    rows = held.collect()
    assert len([r for r in rows if r.member is not None]) <= 20 and len({r.lost for r in rows}) == 1
    lost, n = rows[0].lost, {r.member: r.n for r in rows}
    for m in {x for p in parts for x in p}:
        true = sum(p.count(m) for p in parts)
        assert n.get(m, 0) <= true <= n.get(m, 0) + lost
    assert lost <= 2000 / 21
