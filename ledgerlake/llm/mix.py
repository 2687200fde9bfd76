"""Mixing sources to target weights by Pfair scheduling.

Every source's documents, in a fixed order, are cut into blocks of equal size
(characters).  The weights as given are exact ratios ``c / H`` of integers; the
``j``-th block of a source (from 1) is released at slot ``floor((j - 1) * H / c)``
and due at ``ceil(j * H / c)``; in every slot the released block with the earliest
deadline is taken.  On one schedule with weights that sum to one this meets every
deadline, so after any number of slots each source is less than one block away
from its target share.

The schedule is worked out in ranges of slots, a task each.  What a range needs
to know is which sources are ahead at its first slot (a source has been given its
share rounded down or up, nothing else is possible).  Ranges start from a guess
(earliest deadlines ahead) and are run again where the range before ended
otherwise, until all borders agree; the result is the one of a single run from
slot 0, which forgets its start quickly.  The driver and every range hold a row
per source, nothing per slot, block or document.

The mixture ends when every source has been used up once.  No document is left
out; a source with fewer blocks than its share starts over (a further epoch of
the source).

The order inside a source is a hash of the row; positions come from sums over
hashed buckets and a short running sum inside each, so a source with a third of
all rows is spread over many tasks.

Defined cases.  A null source is a source of its own (the empty name).  Null
texts count as empty; every document counts one character more than its text, so
that empty ones have a place.  A long document begins in one block and fills
those after it.  Repeated rows have a place each.  An empty table gives an empty
mixture.  Input columns keep their values whatever their names, but those called
like one of the new columns are replaced."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_package, written

RANGE_SLOTS = 1 << 18      # slots that a task schedules
PLACES = 512               # slots of a source that travel as one row
BLOCK_CHARS = 1 << 16
ALPHA = 0.7                # default weights: share of characters to this power
BUCKET_ROWS = 4096
BROADCAST_SOURCES = 100_000    # longer tables of a row per source are joined as Spark plans it
NEW = ("mix_source", "mix_slot", "mix_epoch", "mix_block", "mix_offset")


# ---------------------------------------------------------------- schedule

def exact_weights(weights: Sequence[float]) -> list[int]:
    """Integers in exactly the proportion of the given numbers."""
    if not weights or any(not (w > 0) or math.isinf(w) for w in weights):
        raise ValueError("weights must be positive and finite")
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*(w.denominator for w in exact))
    c = [int(w * scale) for w in exact]
    g = math.gcd(*c)
    return [x // g for x in c]


def guess_ahead(c: Sequence[int], total: int, at: int) -> list[int]:
    """The sources that are given their share of ``at`` slots rounded up, if
    those of the earliest deadlines were."""
    done = [at * x // total for x in c]
    open_ = [(-(-(n + 1) * total // x), s) for s, (n, x) in enumerate(zip(done, c)) if n * total < at * x]
    return sorted(s for _, s in heapq.nsmallest(at - sum(done), open_))


def run_range(c: Sequence[int], total: int, begin: int, end: int, ahead: Sequence[int]) -> tuple[np.ndarray, list[int]]:
    """The source of every slot in [begin, end) and the sources ahead at the end."""
    done = [begin * x // total for x in c]
    for s in ahead:
        done[s] += 1
    waiting = [(n * total // x, s) for s, (n, x) in enumerate(zip(done, c))]        # (release, source)
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []                                               # (deadline, source)
    out = np.empty(end - begin, dtype=np.int32)
    for slot in range(begin, end):
        while waiting and waiting[0][0] <= slot:
            s = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(done[s] + 1) * total // c[s]), s))
        s = heapq.heappop(ready)[1]
        out[slot - begin] = s
        done[s] += 1
        heapq.heappush(waiting, (done[s] * total // c[s], s))
    return out, [s for s, (n, x) in enumerate(zip(done, c)) if n > end * x // total]


def schedule(spark, c: Sequence[int], slots: int, range_slots: int = RANGE_SLOTS) -> DataFrame:
    """(s, part, first, slots): the slots of blocks ``first, first + 1, ...`` (from
    0) of source ``s``, all of them with block // PLACES = part."""
    ship_package(spark)
    total, c = sum(c), list(c)
    ranges = max(1, -(-slots // range_slots))
    shared = spark.sparkContext.broadcast(c)         # a number per source
    todo = spark.range(ranges).select(F.col("id").alias("r"), F.lit(None).cast("array<int>").alias("ahead"))

    def begin_of(r, ahead):
        if ahead is None:
            return guess_ahead(shared.value, total, r * range_slots)
        return [int(s) for s in ahead]

    def end_of(r):
        return min((r + 1) * range_slots, slots)

    def borders(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            for r, ahead in zip(pdf["r"].tolist(), pdf["ahead"]):
                before = begin_of(r, ahead)
                after = run_range(shared.value, total, r * range_slots, end_of(r), before)[1]
                yield pd.DataFrame({"r": [r], "ahead": [before], "after": [after]})

    state = "r long, ahead array<int>, after array<int>"
    if ranges > 1:
        known = written(todo.repartition(ranges, "r").mapInPandas(borders, state), "mix-borders")
        while True:
            wrong = known.join(known.select((F.col("r") + 1).alias("r"), F.col("after").alias("right")), "r").where("ahead <> right")
            again = written(wrong.select("r", F.col("right").alias("ahead")), "mix-again")
            if again.isEmpty():
                break
            new = again.repartition(ranges, "r").mapInPandas(borders, state)
            known = written(known.join(again.select("r"), "r", "left_anti").unionByName(new), "mix-borders")
        todo = known.select("r", "ahead")

    def places(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            for r, ahead in zip(pdf["r"].tolist(), pdf["ahead"]):
                before = begin_of(r, ahead)
                begin = r * range_slots
                taken, _ = run_range(shared.value, total, begin, end_of(r), before)
                up = set(before)
                order = np.argsort(taken, kind="stable")
                at = np.flatnonzero(np.concatenate([[True], np.diff(taken[order]) != 0, [True]])) if len(order) else np.zeros(1, int)
                rows = []
                for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
                    s = int(taken[order[i]])
                    block, mine = begin * c[s] // total + (s in up), begin + order[i:j]
                    while len(mine):
                        n = PLACES - block % PLACES
                        rows.append((s, block // PLACES, block, mine[:n]))
                        block, mine = block + n, mine[n:]
                yield pd.DataFrame(rows, columns=["s", "part", "first", "slots"])

    return todo.repartition(ranges, "r").mapInPandas(places, "s int, part long, first long, slots array<long>")


# ---------------------------------------------------------------- operator

def _per_source(df: DataFrame, sources: int) -> DataFrame:
    return F.broadcast(df) if sources <= BROADCAST_SOURCES else df


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source", block_chars: int = BLOCK_CHARS,
                range_slots: int = RANGE_SLOTS) -> DataFrame:
    """``docs`` with (mix_source, mix_slot, mix_epoch, mix_block, mix_offset): a
    row per document and epoch; sorting by (mix_slot, mix_offset) gives the
    mixture.

    Without ``weights`` they follow from the sources' sizes; with them, sources
    not named and names without rows raise."""
    spark = docs.sparkSession
    # Input columns under names of their own: they cannot clash with those here,
    # and those that nobody asks for are not carried.
    held = {f"in_{i}": c for i, c in enumerate(c for c in docs.columns if c not in NEW)}
    d = docs.select(
        *[F.col(f"`{c}`").alias(n) for n, c in held.items()], F.col(id_col).alias("id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        (F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("long") + 1).alias("size"),
        # Hashing the text too tells rows apart that repeat an id.
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("order"))
    totals = sorted(d.groupBy("source").agg(F.sum("size"), F.count(F.lit(1))).collect())     # a row per source
    if not totals:
        return d.select(*[F.col(n).alias(c) for n, c in held.items()], F.col("source").alias("mix_source"),
                        *[F.lit(0).cast("long").alias(c) for c in NEW[1:]])
    names = [r[0] for r in totals]
    if weights is None:
        weights = {s: chars ** ALPHA for s, chars, _ in totals}
    elif set(weights) != set(names):
        raise ValueError(f"weights and sources differ in {sorted(set(weights) ^ set(names))[:10]}")
    c = exact_weights([weights[s] for s in names])
    blocks = [-(-chars // block_chars) for _, chars, _ in totals]
    # Every source's last block is due by then.
    longest = max(-(-n * sum(c) // x) for n, x in zip(blocks, c))
    parts = written(schedule(spark, c, longest, range_slots), "mix-slots")
    table = [(i, s, n, -(-rows // BUCKET_ROWS)) for i, ((s, _, rows), n) in enumerate(zip(totals, blocks))]
    sources = spark.createDataFrame(table, "s int, source string, blocks long, buckets long")
    # The mixture ends with the first block of the last source to be used up.
    last = parts.join(_per_source(sources, len(names)), "s").where("first < blocks AND blocks <= first + size(slots)")
    slots = last.agg(F.max(F.element_at("slots", (F.col("blocks") - F.col("first")).cast("int")))).first()[0] + 1
    given = parts.groupBy("s").agg(F.sum(F.size(F.filter("slots", lambda x: x < slots))).alias("given"))
    sources = sources.join(given, "s")

    # Start of every document in its source: the buckets before its own, then
    # the rows before it in the bucket.
    d = d.join(_per_source(sources, len(names)), "source")
    # Signed 64-bit hashes to equal ranges: the top 31 bits times the buckets.
    top = F.shiftrightunsigned("order", 33)
    d = d.withColumn("bucket", F.floor(top * F.col("buckets") / F.lit(float(1 << 31))).cast("long"))
    sums = d.groupBy("s", "bucket").agg(F.sum("size").alias("sum"))
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("s", "bucket", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("s", "bucket").orderBy(top, "order", "id").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["s", "bucket"])
    d = d.withColumn("offset", F.col("base") + F.col("inside"))
    d = d.withColumn("block", F.floor(F.col("offset") / block_chars).cast("long"))
    epochs = F.floor((F.col("given") - 1 - F.col("block")) / F.col("blocks")).cast("long")
    d = d.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs)))
    d = d.withColumn("j", F.col("block") + F.col("epoch") * F.col("blocks")).withColumn("part", F.floor(F.col("j") / PLACES).cast("long"))
    # A part of a source that two ranges share comes in two rows.
    d = d.join(parts, ["s", "part"]).where("j >= first AND j < first + size(slots)")
    slot = F.element_at("slots", (F.col("j") - F.col("first") + 1).cast("int"))
    found = [F.col("source"), slot, F.col("epoch"), F.col("block"), F.col("offset")]
    return d.select(*[F.col(n).alias(c) for n, c in held.items()], *[x.alias(c) for x, c in zip(found, NEW)])


def mixed_rows(docs: DataFrame, weights: Mapping[str, float] | None = None, **options) -> DataFrame:
    """The mixture itself: the rows of ``docs``, those of later epochs again, in
    the order of the schedule (partitions are consecutive ranges of slots)."""
    m = mix_sources(docs, weights, **options)
    if not set(NEW) & set(docs.columns):
        # Offsets spread a block's rows if slots are few.
        return m.repartitionByRange("mix_slot", "mix_offset").sortWithinPartitions("mix_slot", "mix_offset").select(
            *[F.col(f"`{c}`") for c in docs.columns])
    # Columns with one of the new names come back as they were.
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *[F.col(options.get(o, o.removesuffix("_col") if o != "id_col" else "doc_id")).alias(n)
                         for o, n in (("id_col", "id"), ("text_col", "text"), ("source_col", "source"))])
    return mixed_rows(held, weights, **{**options, "id_col": "id", "text_col": "text", "source_col": "source"}).select("row.*")
