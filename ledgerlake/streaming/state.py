"""Keyed state across micro-batches: ``transformWithStateInPandas`` processors
on the RocksDB provider (ST2, ST3, W8) and a bounded heavy-hitter summary (S17,
T4, ST13).

* :func:`tick_baseline_stream` keeps, per code, the sums of the windows that the
  watermark may still let change and the baseline up to the last final window.
* :func:`last_n_stream` keeps the newest N rows of every key.
* :func:`hot_items_stream` keeps the counters of at most ``capacity`` members.

A key's rows meet in one task, so tasks shrink them first: ticks to one partial
sum per window and Arrow batch, rows to the newest N of a batch; a hot key sends
a few rows a task.  Event-time timers drop keys that were silent for ``idle``;
their state starts anew if they come back.  Rows behind the watermark are left
out, as in every windowed stream."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import monitor as mo
from . import runner as rn
from .jobs import WATERMARK, utc

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOT_CAPACITY = 1000       # counters of the heavy-hitter summary


@contextlib.contextmanager
def rocksdb(spark: SparkSession):
    """The state store that keyed processors need; the setting is put back."""
    old = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, old)


class _Silent:
    """Timer that clears a key ``idle`` milliseconds after its last row."""

    def note(self, handle: StatefulProcessorHandle, idle: int | None, last_ms: int) -> None:
        if idle is None:
            return
        due = [last_ms + idle]
        for t in list(handle.listTimers()):
            due.append(t)
            handle.deleteTimer(t)
        handle.registerTimer(max(due))


# ---------------------------------------------------------------- tick baselines

def _partial_ticks(size_us: int):
    """Sums per (code, window) of an Arrow batch."""
    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            us = t["ts"].cast(pa.timestamp("us", "UTC")).cast(pa.int64()).to_numpy()
            t = t.append_column("ws", pa.array(us - us % size_us))
            g = t.group_by(["stock_code", "ws"]).aggregate(
                [("ts", "max"), ("price", "sum"), ("price", "count"), ("volume", "sum"), ("volume", "count")])
            yield pa.RecordBatch.from_arrays(
                [g[c].combine_chunks() for c in ("stock_code", "ts_max", "ws", "price_sum", "price_count", "volume_sum", "volume_count")],
                names=["stock_code", "ts", "ws", "price", "prices", "volume", "volumes"])
    return run


class TickBaseline(StatefulProcessor):
    """ST2 + ST3 of one code: windows in order, each with the change of its mean
    price against the window before and the volume baseline b0 = v,
    b = (1 - a) b + a v.

    Final windows live on as one row (last window, its mean price, baseline);
    open ones as sums, so a late row renews its window and those after it."""

    def __init__(self, size_us: int, alpha: float, idle_ms: int | None):
        self.size, self.alpha, self.idle = size_us, alpha, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.final = handle.getValueState("final", "ws long, price double, baseline double")
        self.open = handle.getMapState("open", "ws long", "price double, prices long, volume double, volumes long")

    def _step(self, before, sums):
        """(mean price, change, mean volume, baseline, prior baseline)."""
        price = sums[0] / sums[1] if sums[1] else None
        volume = sums[2] / sums[3] if sums[3] else None
        _, prior_price, prior = before or (None, None, None)
        change = (price - prior_price) / prior_price * 100 if price is not None and prior_price else None
        base = prior if volume is None else volume if prior is None else (1 - self.alpha) * prior + self.alpha * volume
        return price, change, volume, base, prior

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = tuple(self.final.get()) if self.final.exists() else None
        held = {int(k[0]): tuple(v) for k, v in self.open.iterator()}
        first, last_ms = None, 0
        for pdf in rows:
            last_ms = max(last_ms, int(pdf["ts"].max().timestamp() * 1000))
            sums = pdf.groupby("ws")[["price", "prices", "volume", "volumes"]].sum()
            for ws, price, prices, volume, volumes in sums.itertuples():
                if before is not None and ws <= before[0]:
                    continue                    # its window is final
                old = held.get(int(ws), (0.0, 0, 0.0, 0))
                held[int(ws)] = (old[0] + float(price), old[1] + int(prices), old[2] + float(volume), old[3] + int(volumes))
                first = int(ws) if first is None else min(first, int(ws))
        done = timerValues.getCurrentWatermarkInMs() * 1000
        out = []
        for ws in sorted(held):
            price, change, volume, base, prior = self._step(before, held[ws])
            if first is not None and ws >= first:
                out.append((key[0], ws, price, change, volume, base, prior))
            if ws + self.size <= done:
                self.final.update((ws, price, base))
                if self.open.containsKey((ws,)):
                    self.open.removeKey((ws,))
            elif first is not None and ws >= first:
                self.open.updateValue((ws,), held[ws])
            before = (ws, price, base)
        _Silent().note(self.handle, self.idle, last_ms)
        yield pd.DataFrame(out, columns=["stock_code", "ws", "avg_price", "change_pct", "avg_volume", "baseline", "prior_baseline"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.final.clear()
        self.open.clear()
        return iter(())

    def close(self) -> None:
        pass


TICKS = "stock_code string, ts timestamp, ws long, price double, prices long, volume double, volumes long"
BASELINES = ("stock_code string, ws long, avg_price double, change_pct double, avg_volume double, baseline double, "
             "prior_baseline double")


def tick_baselines(ticks: DataFrame, size: str, alpha: float = mo.BASELINE_ALPHA, watermark: str = WATERMARK,
                   idle_ms: int | None = None) -> DataFrame:
    """The stream (update mode) of windows of ``size`` (a fixed length) of every
    code.  ``ticks``: stock_code, ts, price, volume; rows without a code or a
    time are left out.  Needs the RocksDB provider when it starts."""
    spark = ticks.sparkSession
    size_us = int(spark.sql(f"SELECT unix_micros(TIMESTAMP '1970-01-01 00:00:00 UTC' + INTERVAL {size})").first()[0])
    rows = ticks.where("stock_code IS NOT NULL AND ts IS NOT NULL").select(
        F.col("stock_code").cast("string").alias("stock_code"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("price").cast("double").alias("price"), F.col("volume").cast("double").alias("volume"))
    parts = rows.mapInArrow(_partial_ticks(size_us), TICKS).withWatermark("ts", watermark)
    out = parts.groupBy("stock_code").transformWithStateInPandas(
        TickBaseline(size_us, alpha, idle_ms), outputStructType=T._parse_datatype_string(BASELINES),
        outputMode="Update", timeMode="EventTime")
    start = F.timestamp_micros(F.col("ws")).cast("timestamp_ntz").alias("window_start")
    return out.select("stock_code", start, "avg_price", "change_pct", "avg_volume", "baseline", "prior_baseline")


def tick_baseline_stream(spark: SparkSession, ticks: DataFrame, size: str, **options) -> DataFrame:
    """ST2 + ST3 live, run to the end of the input and read back."""
    with utc(spark), rocksdb(spark):
        base = rn.run_dir(spark, "tick_baselines")
        rn.run(tick_baselines(ticks, size, **options), f"{base}/checkpoint", f"{base}/sink", "update")
    return rn.read_latest(spark, f"{base}/sink", ["stock_code", "window_start"])


# ---------------------------------------------------------------- last N rows

def _newest(n: int, order: list[tuple[str, str]]):
    """The newest ``n`` rows of every key of an Arrow batch."""
    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch]).sort_by([("_key", "ascending"), *order])
            keys = t["_key"].combine_chunks()
            new = pa.compute.fill_null(pa.compute.not_equal(keys[1:], keys[:-1]), True) if len(keys) > 1 else pa.array([], pa.bool_())
            start = pd.Series([True, *new.to_pylist()]) if len(keys) else pd.Series([], dtype=bool)
            place = pd.Series(range(len(keys))) - pd.Series(range(len(keys))).where(start).ffill()
            yield from t.filter(pa.array(place < n)).combine_chunks().to_batches()
    return run


class LastN(StatefulProcessor):
    """W8 of one key: its newest ``n`` rows by ``order`` (largest first)."""

    def __init__(self, n: int, row: str, columns: list[str], order: list[str], ts: str, idle_ms: int | None):
        self.n, self.row, self.columns, self.order, self.ts, self.idle = n, row, columns, order, ts, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.row)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        places = [self.columns.index(c) for c in self.order]
        held, last_ms = [tuple(r) for r in self.rows.get()], 0
        for pdf in rows:
            last_ms = max(last_ms, int(pdf[self.ts].max().timestamp() * 1000))
            new = pdf[self.columns].astype(object).where(pdf[self.columns].notna(), None)
            held += [tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in r)
                     for r in new.itertuples(index=False, name=None)]
            held.sort(key=lambda r: tuple(r[p] for p in places), reverse=True)
            del held[self.n:]
        self.rows.put(held)
        _Silent().note(self.handle, self.idle, last_ms)
        yield pd.DataFrame({"_key": [key[0]], "last": [[dict(zip(self.columns, r)) for r in held]]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.rows.clear()
        return iter(())

    def close(self) -> None:
        pass


def last_n(rows: DataFrame, key: str, ts: str, tie: str, columns: Sequence[str], n: int, watermark: str = WATERMARK,
           idle_ms: int | None = None) -> DataFrame:
    """The stream (update mode): (_key, last) with the newest ``n`` rows of
    every key met in the batch, by ``ts`` and ``tie``, newest first.  Rows
    without a key, a time or a tie are left out."""
    rest = [c for c in columns if c not in (ts, tie)]
    kept = rows.where(F.col(key).isNotNull() & F.col(ts).isNotNull() & F.col(tie).isNotNull()).select(
        F.col(key).alias("_key"), F.col(ts).cast("timestamp").alias(ts), F.col(tie).alias(tie), *rest)
    fields = [ts, tie, *rest]
    row = T.StructType([kept.schema[c] for c in fields])
    few = kept.mapInArrow(_newest(n, [(ts, "descending"), (tie, "descending")]), kept.schema).withWatermark(ts, watermark)
    out = T.StructType().add("_key", kept.schema["_key"].dataType).add("last", T.ArrayType(row))
    return few.groupBy("_key").transformWithStateInPandas(
        LastN(n, row.simpleString()[7:-1].replace(":", " "), fields, [ts, tie], ts, idle_ms), outputStructType=out,
        outputMode="Update", timeMode="EventTime")


def last_n_stream(spark: SparkSession, rows: DataFrame, key: str, ts: str, tie: str, columns: Sequence[str], n: int,
                  **options) -> DataFrame:
    """W8 live, run to the end of the input: (key, columns) of the newest ``n``
    rows of every key."""
    with utc(spark), rocksdb(spark):
        base = rn.run_dir(spark, "last_n")
        rn.run(last_n(rows, key, ts, tie, columns, n, **options), f"{base}/checkpoint", f"{base}/sink", "update")
        out = rn.read_latest(spark, f"{base}/sink", ["_key"]).select("_key", F.inline("last"))
    return out.select(F.col("_key").alias(key), *[F.col(c).cast("timestamp_ntz").alias(c) if c == ts else F.col(c) for c in columns])


# ---------------------------------------------------------------- hot items

def merge_counters(counters: DataFrame, capacity: int) -> DataFrame:
    """One summary of at most ``capacity`` (member, n) of added counters, with
    ``lost``: what was taken from every counter to get there.  A member's true
    count lies between its n and n + lost; one without a counter has at most
    lost (merge rule of frequent-item summaries).

    ``counters``: (member, n, lost), lost the same for all rows of a summary, a
    null member carries a summary's lost alone."""
    total = counters.where("member IS NOT NULL").groupBy("member").agg(F.sum("n").alias("n"))
    lost = counters.agg(F.coalesce(F.max("lost"), F.lit(0)).cast("long").alias("old"))
    # capacity + 1 rows: bounded by the parameter.
    top = total.orderBy(F.desc("n"), "member").limit(capacity + 1)
    cut = top.agg(F.when(F.count(F.lit(1)) > capacity, F.min("n")).otherwise(0).cast("long").alias("cut"))
    rows = top.crossJoin(F.broadcast(cut)).select("member", (F.col("n") - F.col("cut")).alias("n")).where("n > 0")
    rows = rows.unionByName(counters.sparkSession.range(1).select(F.lit(None).cast(total.schema["member"].dataType).alias("member"),
                                                                 F.lit(0).cast("long").alias("n")))
    return rows.crossJoin(F.broadcast(cut.crossJoin(lost).select((F.col("cut") + F.col("old")).alias("lost"))))


def hot_items_stream(spark: SparkSession, events: DataFrame, member: str, table: DataFrame, top: int = 10,
                     capacity: int = HOT_CAPACITY) -> DataFrame:
    """The ``top`` members by count: the stream's summary names the candidates,
    one pass over ``table`` (the same rows at rest) counts these exactly.

    State between micro-batches is one summary of ``capacity`` counters; a batch
    writes its own, merged from the one before, so a replay changes nothing.
    Where the last place counts no more than the summary lost, a member without
    a counter could belong there, and all members are counted."""
    events = events.where(F.col(member).isNotNull()).select(F.col(member).alias("member"))
    kind = events.schema["member"].dataType.simpleString()
    schema = f"member {kind}, n long, lost long"
    base = rn.run_dir(spark, "hot_items")

    def state(epoch_id: int) -> str:
        return f"{base}/sink/{rn.BATCH}={epoch_id}"

    def write(batch: DataFrame, epoch_id: int) -> None:
        held = spark.read.schema(schema).parquet(state(epoch_id - 1))
        new = batch.groupBy("member").agg(F.count(F.lit(1)).alias("n")).withColumn("lost", F.lit(0).cast("long"))
        rn.batch_sink(f"{base}/sink")(merge_counters(held.unionByName(new), capacity).coalesce(1), epoch_id)

    with utc(spark):
        spark.createDataFrame([], schema).write.parquet(state(-1))
        rn.run(events, f"{base}/checkpoint", f"{base}/sink", "append", write=write)
    sink = spark.read.parquet(f"{base}/sink")
    newest = sink.agg(F.max(rn.BATCH)).first()[0]
    rows = table.where(F.col(member).isNotNull()).select(F.col(member).alias("member"))
    if newest is None:
        return _top(rows, member, top)
    summary = spark.read.schema(schema).parquet(state(newest))
    lost = summary.agg(F.coalesce(F.max("lost"), F.lit(0))).first()[0]
    counted = _top(rows.join(F.broadcast(summary.where("member IS NOT NULL").select("member")), "member"), member, top)
    if lost == 0:
        return counted
    known = counted.agg(F.count(F.lit(1)), F.min("hits")).first()
    return counted if known[0] == top and known[1] > lost else _top(rows, member, top)


def _top(rows: DataFrame, member: str, top: int) -> DataFrame:
    return rows.groupBy(F.col("member").alias(member)).agg(F.count(F.lit(1)).alias("hits")).orderBy(F.desc("hits"), member).limit(top)
