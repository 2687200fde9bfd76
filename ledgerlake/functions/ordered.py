"""Order-dependent primitives that stay distributed.

Everything here avoids the two Spark patterns that break at scale:

* ``Window.orderBy(...)`` with no partition key, which pulls every row into
  one task, and
* exact ``percentile`` / ``mode`` aggregates on a global or hot group, which
  merge every distinct value into one task.

The building block is :func:`dense_index`: one range-partitioned sort, the
per-partition row counts (one row per sorted partition, so the table that is
broadcast is bounded by the partition count, not by the data) and
``monotonically_increasing_id`` give every row its global position - the
DataFrame form of ``zipWithIndex``.  The sorted, id-tagged rows are
checkpointed to the session's checkpoint folder first: every later branch of
the plan (counts, offsets, the rows themselves) then reads the same stored
partitions, whatever AQE does to the shuffles of a pruned branch, and a lost
executor cannot make a recomputation disagree with the stored ids.  On top of
it:

* :func:`exact_quantiles` - linear-interpolated quantiles (numpy / pandas /
  DuckDB ``quantile_cont`` rule) by rank selection, optionally per group.
* :func:`blocked` - cuts the ordered rows into fixed-size blocks of consecutive
  positions, so that windows run per (key, block) and a hot key is spread over
  many tasks; ``halo`` rows copied from the neighbour block give lags and
  rolling frames their context.
* :func:`carry_fill` - forward / backward fill across blocks.
* :func:`ewm` - exact exponentially weighted mean by blocked prefix sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOCAL_MASK = (1 << 33) - 1  # monotonically_increasing_id = pid << 33 | row
DEFAULT_BLOCK_ROWS = 1 << 20
# Largest number of distinct (group, column, value) entries for which the
# exact in-memory ``percentile`` aggregate is used; above it, rank selection.
EXACT_MAP_LIMIT = 2_000_000


def _cols(xs) -> list:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def dense_index(df: DataFrame, order: Sequence, idx_col: str = "_idx") -> DataFrame:
    """Add ``idx_col``: the 0-based position of each row in ``order``.

    ``order`` must be unique for a deterministic result (rows that tie may
    swap places, which is harmless only when they are identical).
    """
    ensure_checkpoint_dir(df.sparkSession)
    s = df.orderBy(*_cols(order)).withColumn("_mid", F.monotonically_increasing_id())
    # Persisted only while the checkpoint is written: a reliable checkpoint
    # of an unpersisted frame computes the whole upstream a second time.
    s = s.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        s_ck = s.checkpoint(eager=True)
    finally:
        s.unpersist()
    s = s_ck
    s = s.withColumn("_pid", F.shiftright(F.col("_mid"), 33))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per range partition: the window below has no key, but its input
    # is bounded by the number of shuffle partitions.
    prior = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(prior), F.lit(0)).alias("_off"))
    out = s.join(F.broadcast(offsets), "_pid")
    out = out.withColumn(idx_col, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)))
    return out.drop("_mid", "_pid", "_off")


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric ``cols`` to (by..., _c, _v) without nulls / NaN."""
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v"))
                             for c in cols])).alias("_s")
    out = df.select(*by, st).select(*by, "_s._c", "_s._v")
    return out.where(F.col("_v").isNotNull() & ~F.isnan("_v"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), approx: bool = False,
                    accuracy: int = 100000, map_limit: int | None = None) -> DataFrame:
    """Quantiles with linear interpolation, returned long:
    (by..., column, prob, value).

    Exact mode sorts the unpivoted values once and picks the two ranks around
    ``p*(n-1)`` per (group, column, prob).  No task ever holds more than its
    own sorted range, so a group holding a third of all rows is fine.
    ``approx=True`` is the one-pass ``percentile_approx`` alternative with
    relative rank error 1/accuracy.  With ``map_limit`` (default
    ``EXACT_MAP_LIMIT``) inputs of at most that many values use Spark's exact
    one-pass ``percentile`` instead (same interpolation rule).
    """
    if map_limit is None:
        map_limit = EXACT_MAP_LIMIT
    by = list(by)
    probs = [float(p) for p in probs]
    lv = long_values(df, cols, by)
    if not approx and map_limit:
        # Size check: Spark's exact ``percentile`` keeps one map of distinct
        # values per (group, column) and merges it in the final task; take
        # that one-pass path only when all maps together stay under
        # ``map_limit`` entries (HyperLogLog estimate, 5% error, with a
        # 1.25 safety factor).
        n = lv.agg(F.approx_count_distinct(F.struct(*by, "_c", "_v"), 0.05)).first()[0] or 0
        if n * 1.25 <= map_limit:
            arr = F.array(*[F.lit(p) for p in probs])
            q = lv.groupBy(*by, "_c").agg(F.percentile("_v", arr).alias("_qs"))
            out = q.select(*by, "_c", F.posexplode("_qs").alias("_i", "_q"))
            return out.select(*by, F.col("_c").alias("column"), F.element_at(arr, F.col("_i") + 1).alias("prob"),
                              F.col("_q").alias("value"))
    if approx:
        q = lv.groupBy(*by, "_c").agg(
            F.percentile_approx("_v", F.array(*[F.lit(p) for p in probs]), accuracy).alias("_qs"))
        out = q.select(*by, "_c", F.posexplode("_qs").alias("_i", "_q"))
        pr = F.array(*[F.lit(p) for p in probs])
        return out.select(*by, F.col("_c").alias("column"), F.element_at(pr, F.col("_i") + 1).alias("prob"),
                          F.col("_q").alias("value"))
    ix = dense_index(lv, [*by, "_c", "_v"])
    stats = ix.groupBy(*by, "_c").agg(F.min("_idx").alias("_start"), F.count(F.lit(1)).alias("_n"))
    t = stats.select(*by, "_c", "_start", "_n",
                     F.explode(F.array(*[F.lit(p) for p in probs])).alias("_p"))
    t = (t.withColumn("_pos", F.col("_p") * (F.col("_n") - 1))
          .withColumn("_fl", F.floor("_pos"))
          .withColumn("_lo", F.col("_start") + F.col("_fl"))
          .withColumn("_hi", F.col("_start") + F.ceil("_pos")))
    need = t.select(F.col("_lo").alias("_idx")).union(t.select(F.col("_hi").alias("_idx"))).distinct()
    vals = ix.join(need, "_idx", "left_semi").select("_idx", "_v")
    lo = vals.select(F.col("_idx").alias("_lo"), F.col("_v").alias("_vlo"))
    hi = vals.select(F.col("_idx").alias("_hi"), F.col("_v").alias("_vhi"))
    res = t.join(lo, "_lo").join(hi, "_hi")
    val = F.col("_vlo") + (F.col("_pos") - F.col("_fl")) * (F.col("_vhi") - F.col("_vlo"))
    return res.select(*by, F.col("_c").alias("column"), F.col("_p").alias("prob"), val.alias("value"))


BRACKET_ACCURACY = 10000
BRACKET_LIMIT = 20_000  # values collected per (column, probability)


_HALF = 1 << 32          # of a sum that holds two counts
SKETCH_VALUES = 4096     # values of a column that the first pass's sketch holds exactly
SKETCH_ERROR = 0.004     # ranks off at most, as a share, with room to spare; checked by counting


def sketch_quantiles(spark, asked: Sequence[tuple[bytes, Sequence[float]]]) -> list[list[float]]:
    """Per (KLL sketch, ranks as shares) the values at these ranks; worked out
    on literals, without reading anything."""
    if not asked:
        return []
    row = spark.sql("SELECT 1 AS one").select(*[
        F.kll_sketch_get_quantile_double(F.lit(bytearray(sketch)), F.array(*[F.lit(float(r)) for r in ranks])).alias(f"q{i}")
        for i, (sketch, ranks) in enumerate(asked)]).first()
    return [list(q) for q in row]


class _Bracket:
    """A quantile in the making: the ranks it needs, those already known, and
    two values between which the others lie."""

    def __init__(self, col: str, pos: float, lo: float, hi: float, ends: tuple[float, float]):
        self.col, self.pos, self.ends = col, pos, ends
        self.known: dict[int, float | None] = {int(math.floor(pos)): None, int(math.ceil(pos)): None}
        self.lo, self.hi, self.slack = lo, hi, 1
        self.before = self.inside = 0     # values up to lo, values strictly between

    @property
    def open(self) -> list[int]:
        return [r for r, v in self.known.items() if v is None]

    def around(self) -> tuple[float, float, float]:
        return self.known[int(math.floor(self.pos))], self.known[int(math.ceil(self.pos))], self.pos - math.floor(self.pos)

    def counted(self, below: int, at_lo: int, between: int, at_hi: int) -> None:
        """Settle the ranks that fall on an end; ends that miss a rank give way
        to the column's extremes."""
        self.before, self.inside = below + at_lo, between
        end = self.before + between + (at_hi if self.hi > self.lo else 0)
        if any(not below <= r < end for r in self.open):
            self.lo, self.hi = self.ends
            self.inside, self.slack = None, self.slack * 4   # room for error next time
            return
        for r in self.open:
            if r < self.before:
                self.known[r] = self.lo
            elif r >= self.before + between:
                self.known[r] = self.hi


def quantile_params(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    approx: bool = False) -> dict[str, dict[float, float]]:
    """Global quantiles as a driver-side parameter dict {col: {p: value}}, exact
    by :func:`quantile_neighbours` unless ``approx``."""
    if approx:
        out: dict[str, dict[float, float]] = {c: {} for c in cols}
        for r in exact_quantiles(df, cols, probs, approx=True).collect():
            out[r["column"]][float(r["prob"])] = r["value"]
        return out
    found, _ = quantile_neighbours(df, cols, probs)
    return {c: {p: between(*v) for p, v in q.items()} for c, q in found.items()}


def between(lo: float, hi: float, share: float) -> float:
    return lo + share * (hi - lo)


def quantile_neighbours(df: DataFrame, cols: Sequence[str],
                        probs: Sequence[float]) -> tuple[dict[str, dict[float, tuple[float, float, float]]], set[str]]:
    """{col: {p: (value before, value after, share of the way)}} of the quantiles,
    and, if any has NaN (which counts as no value), the columns that may.

    Exact by narrowing brackets, whatever the size: pass 1 is one aggregate
    with the count and a KLL sketch per column.  A column of at most
    ``SKETCH_VALUES`` values is in its sketch as a whole: the quantiles follow
    without another job.  For others the sketch's values at p -/+ the error
    enclose the ranks floor/ceil of p*(n-1).  Then, for all quantiles still open
    at once, a pass counts the values below, at and between the ends of their
    brackets: ranks on an end are known (ties cost nothing).  Brackets with at
    most ``BRACKET_LIMIT`` values between are collected; wider ones are narrowed
    by an approximate pass over their inside, which leaves about
    4/``BRACKET_ACCURACY`` of it.  Rows are never sorted or stored."""
    probs = [float(p) for p in probs]
    out: dict[str, dict[float, tuple[float, float, float]]] = {c: {} for c in cols}
    a = BRACKET_ACCURACY
    eps = 2.0 / a
    val = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(val[c]).alias(f"n{i}"), F.min(val[c]).alias(f"a{i}"), F.max(val[c]).alias(f"z{i}"),
                 F.kll_sketch_agg_double(val[c], SKETCH_VALUES).alias(f"s{i}")]
    floats = [c for c in cols if df.schema[c].dataType.typeName() in ("double", "float")]
    any_nan = [F.isnan(c) for c in floats]
    if any_nan:
        aggs.append(F.max(F.greatest(F.lit(False), *any_nan)).alias("nan"))
    row = df.agg(*aggs).first() if cols else None
    some = [(i, c) for i, c in enumerate(cols) if row[f"n{i}"]]
    nans = set(floats) if any_nan and row["nan"] else set()

    def ranks(n):
        """Two shares per quantile: its two neighbours, or ends around them."""
        if n <= SKETCH_VALUES:
            return [min(1.0, (f(p * (n - 1)) + 1) / n) for p in probs for f in (math.floor, math.ceil)]
        return [min(1.0, max(0.0, p + d)) for p in probs for d in (-SKETCH_ERROR, SKETCH_ERROR)]

    found = sketch_quantiles(df.sparkSession, [(row[f"s{i}"], ranks(row[f"n{i}"])) for i, _ in some])
    todo: dict[tuple, _Bracket] = {}
    for (i, c), q in zip(some, found):
        n = row[f"n{i}"]
        for k, p in enumerate(probs):
            pos, lo, hi = p * (n - 1), q[2 * k], q[2 * k + 1]
            if n <= SKETCH_VALUES:
                out[c][p] = lo, hi, pos - math.floor(pos)
            else:
                todo[c, p] = _Bracket(c, pos, lo, hi, (row[f"a{i}"], row[f"z{i}"]))
    done = dict(todo)
    # Two counts in one sum: Spark compiles an aggregate of at most 100 fields.
    halves = all(row[f"n{i}"] < _HALF // 2 for i, _ in some)
    while todo:
        aggs = []
        for j, b in enumerate(todo.values()):
            v = val[b.col]
            conds = [v < b.lo, v == b.lo, (v > b.lo) & (v < b.hi), v == b.hi]
            if halves:
                for name, (x, y) in (("b", conds[:2]), ("m", conds[2:])):
                    aggs.append(F.sum(F.when(x, 1).when(y, _HALF).otherwise(0)).alias(f"{name}{j}"))
            else:
                aggs += [F.count(F.when(x, 1)).alias(f"{name}{j}") for name, x in zip("blmh", conds)]
        cnt = df.agg(*aggs).first()
        for j, b in enumerate(todo.values()):
            if halves:
                (l, below), (h, inside) = (divmod(cnt[f"{name}{j}"] or 0, _HALF) for name in "bm")
                b.counted(below, l, inside, h)
            else:
                b.counted(cnt[f"b{j}"], cnt[f"l{j}"], cnt[f"m{j}"], cnt[f"h{j}"])
        todo = {k: b for k, b in todo.items() if b.open}
        small = [b for b in todo.values() if b.inside is not None and b.inside <= BRACKET_LIMIT]
        wide = [b for b in todo.values() if b.inside is not None and b.inside > BRACKET_LIMIT]
        aggs = [F.collect_list(F.when((val[b.col] > b.lo) & (val[b.col] < b.hi), val[b.col])).alias(f"v{j}")
                for j, b in enumerate(small)]
        for j, b in enumerate(wide):
            at = [(r - b.before) / b.inside for r in b.open]
            ends = [max(0.0, min(at) - eps * b.slack), min(1.0, max(at) + eps * b.slack)]
            inside = F.when((val[b.col] > b.lo) & (val[b.col] < b.hi), val[b.col])
            aggs.append(F.percentile_approx(inside, F.array(*[F.lit(x) for x in ends]), a).alias(f"w{j}"))
        if aggs:
            got = df.agg(*aggs).first()
            for j, b in enumerate(small):
                vals = sorted(got[f"v{j}"])
                for r in b.open:
                    b.known[r] = vals[r - b.before]
            for j, b in enumerate(wide):
                b.lo, b.hi = got[f"w{j}"]
        todo = {k: b for k, b in todo.items() if b.open}
    for (c, p), b in done.items():
        out[c][p] = b.around()
    return out, nans


# --------------------------------------------------------------------------
# Blocked ordered windows
# --------------------------------------------------------------------------

def blocked(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (),
            block_rows: int = DEFAULT_BLOCK_ROWS, back: int = 0, fwd: int = 0) -> DataFrame:
    """Index rows by (keys, order) and cut them into blocks of ``block_rows``
    consecutive positions.  Adds ``_idx``, ``_blk`` and ``_halo``.

    ``back`` / ``fwd`` copy the last ``back`` rows of each block into the next
    block and the first ``fwd`` rows into the previous one, flagged
    ``_halo = true``; windows partitioned by (keys, _blk) then see the
    neighbours they need, and the caller drops the halo rows afterwards.
    Rows of another key never leak in, because keys are part of the window
    partition.
    """
    b = int(block_rows)
    ix = dense_index(df, [*keys, *order]).withColumn("_blk", F.floor(F.col("_idx") / b))
    base = ix.withColumn("_halo", F.lit(False))
    parts = [base]
    pos = F.col("_idx") - F.col("_blk") * b
    if back:
        parts.append(ix.where(pos >= b - back).withColumn("_blk", F.col("_blk") + 1)
                     .withColumn("_halo", F.lit(True)))
    if fwd:
        parts.append(ix.where(pos < fwd).withColumn("_blk", F.col("_blk") - 1)
                     .withColumn("_halo", F.lit(True)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def block_window(keys: Sequence[str] = ()) -> Window:
    return Window.partitionBy(*keys, "_blk").orderBy("_idx")


def ordered_window_apply(df: DataFrame, order: Sequence[str], keys: Sequence[str],
                         make_cols, back: int = 0, fwd: int = 0,
                         block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Run row-frame window expressions ``make_cols(w) -> [Column]`` over rows
    ordered by ``order`` within ``keys`` (or globally when ``keys`` is
    empty) without a single-task window.  Frames must not reach further
    than ``back`` rows before / ``fwd`` rows after the current row."""
    bl = blocked(df, order, keys, block_rows, back, fwd)
    w = block_window(keys)
    out = bl.select("*", *make_cols(w)).where(~F.col("_halo"))
    return out.drop("_halo", "_blk")


def carry_fill(ix: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
               forward: bool = True) -> DataFrame:
    """Forward (or backward) fill ``cols`` in ``_idx`` order within ``keys``
    on a frame that already has ``_idx`` and ``_blk`` (see :func:`blocked`).

    Inside a block a window does the fill; the value carried in from earlier
    (later) blocks comes from a per-block table with one row per
    (key, block), i.e. data size / block size rows."""
    # Both directions use a running frame (unbounded preceding .. current
    # row); the backward fill runs it in descending order, because a
    # current .. unbounded following frame is re-evaluated for every row.
    w = Window.partitionBy(*keys, "_blk").orderBy(F.col("_idx") if forward else F.col("_idx").desc())
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    inner = {c: F.last(c, ignorenulls=True).over(frame) for c in cols}
    pick_edge = F.max if forward else F.min
    edge = [pick_edge(F.when(F.col(c).isNotNull(), F.struct(F.col("_idx"), F.col(c).alias("v")))).alias(c)
            for c in cols]
    per_blk = ix.groupBy(*keys, "_blk").agg(*edge)
    bw = Window.partitionBy(*keys).orderBy(F.col("_blk") if forward else F.col("_blk").desc())
    bframe = bw.rowsBetween(Window.unboundedPreceding, -1)
    carry = per_blk.select(*keys, "_blk", *[F.last(F.col(c)["v"], ignorenulls=True).over(bframe).alias(f"_carry_{c}")
                                           for c in cols])
    filled = ix.select(*[F.col(x) for x in ix.columns if x not in cols],
                       *[inner[c].alias(c) for c in cols])
    out = filled.join(carry, [*keys, "_blk"], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_carry_{c}"))).drop(f"_carry_{c}")
    return out


# --------------------------------------------------------------------------
# Exponentially weighted mean
# --------------------------------------------------------------------------

def ewm_block_rows(alpha: float) -> int:
    """Block length for the prefix-sum EWM: r^-B stays near e^100 (no
    overflow) and r^B near e^-100, so carries older than one block vanish
    below double precision."""
    r = 1.0 - alpha
    return max(8, int(math.ceil(100.0 / -math.log(r)))) if r > 0 else 1


def ewm(df: DataFrame, value_col: str, alpha: float, order: Sequence[str],
        keys: Sequence[str] = (), out_col: str = "ewm",
        block_rows: int | None = None) -> DataFrame:
    """``y0 = x0, y = a*x + (1-a)*y_prev`` per key in ``order`` (pandas
    ``ewm(adjust=False)``); see :func:`ewm_multi`."""
    return ewm_multi(df, [(value_col, alpha, out_col)], order, keys, block_rows=block_rows)


def ewm_multi(df: DataFrame, specs: Sequence[tuple[str, float, str]], order: Sequence[str],
              keys: Sequence[str] = (), indexed: bool = False, block_rows: int | None = None) -> DataFrame:
    """Several EWMs ``(value_col, alpha, out_col)`` over the same rows, exact
    to floating-point precision and JVM-only.

    Inside a block of B consecutive rows y is a prefix sum of x*r^-j scaled
    by r^j; the state entering a block is the previous block's last local
    value, joined on (key, block - 1).  B is at least ``ewm_block_rows`` for
    every alpha, so r^B is below double precision and older blocks do not
    matter.  A key with a third of all rows is spread over many blocks.
    With ``indexed=True`` the frame already carries ``_idx`` (from
    :func:`blocked` or :func:`dense_index`) in (keys, order) order.
    """
    keys = list(keys)
    b = max([block_rows or 0] + [ewm_block_rows(a) for _, a, _ in specs])
    for _, a, _ in specs:
        if b * -math.log(1.0 - a) > 690:
            raise ValueError("alphas too far apart for one blocked pass; call ewm_multi per alpha")
    ix = df if indexed else dense_index(df, [*keys, *order])
    ix = ix.withColumn("_eblk", F.floor(F.col("_idx") / b))
    if keys:
        starts = ix.groupBy(*keys).agg(F.min("_idx").alias("_kstart"))
        ix = ix.join(starts, keys)
    else:
        ix = ix.withColumn("_kstart", F.lit(0).cast("long"))
    gw = Window.partitionBy(*keys, "_eblk")
    ow = gw.orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    loc = ix.withColumn("_j", (F.col("_idx") - F.min("_idx").over(gw)).cast("double"))
    first = F.col("_idx") == F.col("_kstart")
    for v, a, o in specs:
        r = 1.0 - a
        weight = F.when(first, F.lit(1.0 / a)).otherwise(F.lit(1.0))
        loc = loc.withColumn(f"_loc_{o}", F.lit(a) * F.pow(F.lit(r), F.col("_j")) *
                             F.sum(weight * F.col(v).cast("double") * F.pow(F.lit(r), -F.col("_j"))).over(ow))
    last = loc.groupBy(*keys, "_eblk").agg(*[F.max_by(f"_loc_{o}", "_idx").alias(f"_prev_{o}") for _, _, o in specs])
    last = last.withColumn("_eblk", F.col("_eblk") + 1)
    out = loc.join(last, [*keys, "_eblk"], "left")
    for _, a, o in specs:
        out = out.withColumn(o, F.col(f"_loc_{o}") + F.pow(F.lit(1.0 - a), F.col("_j") + 1) *
                             F.coalesce(F.col(f"_prev_{o}"), F.lit(0.0)))
    drop = ["_eblk", "_kstart", "_j"] + [x for _, _, o in specs for x in (f"_loc_{o}", f"_prev_{o}")]
    if not indexed:
        drop.append("_idx")
    return out.drop(*drop)


def ewm_sql(value_expr: str, alpha: float, partition: str, order: str) -> str:
    """DuckDB oracle for :func:`ewm`: fold the ordered prefix with list_reduce."""
    return (f"list_reduce(list({value_expr}::DOUBLE) OVER (PARTITION BY {partition} ORDER BY {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"lambda acc, x: {alpha!r} * x + {1 - alpha!r} * acc)")


def prefix_sum(df: DataFrame, value_col: str, order: Sequence[str], out_col: str = "prefix",
               inclusive: bool = True, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Running sum of ``value_col`` in ``order`` over the whole table: a
    running window inside each block plus the total of all earlier blocks
    (one row per block, so that window is bounded by rows / block_rows)."""
    ix = dense_index(df, order).withColumn("_blk", F.floor(F.col("_idx") / block_rows))
    frame = Window.partitionBy("_blk").orderBy("_idx").rowsBetween(Window.unboundedPreceding,
                                                                   0 if inclusive else -1)
    inner = ix.withColumn(out_col, F.coalesce(F.sum(value_col).over(frame), F.lit(0)))
    tot = ix.groupBy("_blk").agg(F.sum(value_col).alias("_bt"))
    prior = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_blk", F.coalesce(F.sum("_bt").over(prior), F.lit(0)).alias("_boff"))
    out = inner.join(offs, "_blk").withColumn(out_col, F.col(out_col) + F.col("_boff"))
    return out.drop("_idx", "_blk", "_boff")


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the session's checkpoint folder (persisted only
    while it is written): later branches read the stored result instead of
    recomputing an expensive plan, and lineage is cut."""
    ensure_checkpoint_dir(df.sparkSession)
    p = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return p.checkpoint(eager=True)
    finally:
        p.unpersist()
