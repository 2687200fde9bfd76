"""SimHash near-duplicate detection by meet-in-the-middle ball hashing.

Two fingerprints at most ``k`` bits apart have a common variant: a value at
most ``k/2`` bits from each.  Every distinct fingerprint therefore expands to
all variants within ``k/2`` bits (2081 for 64 bits and ``k = 4``), and
fingerprints that meet on a variant are linked.  The variants are shuffled by
their leading bits: all variants of one fingerprint that share those bits
travel as one (prefix, fingerprint) row and are written out inside the
receiving task, so the shuffle carries some tens of rows per fingerprint
where a row per variant would carry 2081.

Because both fingerprints lie within ``k/2`` of the variant they meet on, a
meeting always means a link; the distance is verified all the same.  Those
that meet on a variant are chained, not paired off, and a task reports a
spanning forest of its fingerprints: a group of ``m`` near copies costs at
most ``m - 1`` rows a task, never ``m * m``.  Equal fingerprints are one row
from the start, so exact copies cost nothing here."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import release_memory, ship_package, written

BITS = 64
# Variants that a task writes out at a time (memory) and that a prefix holds
# on average (number of prefixes); neither changes the result.
BLOCK_VARIANTS = 1 << 21
PREFIX_VARIANTS = 1 << 22
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """64-bit SimHash, as a signed integer, of the shingles of one text.

    A-Z are lower-cased, words are runs without ASCII white space, a shingle is
    ``shingle`` words joined by spaces (fewer words: all of them; none: zero)."""
    import xxhash
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return _signed(xxhash.xxh64_intdigest(b" ".join(words), 42))
    h = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    start = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum([len(w) + 1 for w in words], out=start[1:])
    n = len(words) - shingle + 1
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, _CHUNK):
        j = min(n, i + _CHUNK)
        hs = np.array([h(joined[s:e], 42) for s, e in
                       zip(start[i:j].tolist(), (start[i + shingle:j + shingle] - 1).tolist())], dtype=">u8")
        ones += np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits).view(">i8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 4, out: str = "fp") -> DataFrame:
    """``docs`` with a long column ``out`` (null and empty text: 0)."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
            release_memory()

    return docs.withColumn(out, fp(F.col(text_col).cast("binary")))


def flip_masks(bits: int, flips: int) -> list[np.ndarray]:
    """Masks of the low ``bits`` bits by their number of set bits, 0 to ``flips``."""
    one = [np.uint64(1 << i) for i in range(bits)]
    return [np.array([np.bitwise_or.reduce(np.array(c, dtype=np.uint64)) if c else np.uint64(0)
                      for c in itertools.combinations(one, w)], dtype=np.uint64) for w in range(flips + 1)]


def _variants(low: np.ndarray, owner: np.ndarray, spent: np.ndarray, bits: int, radius: int,
              limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (variant, owner): all values of ``low`` with at most
    ``radius - spent`` of its ``bits`` bits flipped.  Too large a block is cut
    by the next leading bits, as the whole job is cut by its prefixes."""
    masks = flip_masks(bits, radius)
    per = np.cumsum([len(m) for m in masks])
    if bits > 8 and int(per[radius - spent].sum()) > limit:
        cut, rest = 4, bits - 4
        for sub in range(1 << cut):
            top = (low >> np.uint64(rest)) ^ np.uint64(sub)
            now = spent + np.bitwise_count(top)
            ok = now <= radius
            if ok.any():
                yield from _variants(low[ok] & np.uint64((1 << rest) - 1), owner[ok], now[ok], rest, radius, limit)
        return
    keys, own = [], []
    for s in range(radius + 1):
        at = np.flatnonzero(spent == s)
        if len(at):
            m = np.concatenate(masks[: radius - s + 1])
            keys.append((low[at, None] ^ m[None, :]).ravel())
            own.append(np.repeat(owner[at], len(m)))
    if keys:
        yield np.concatenate(keys), np.concatenate(own)


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the pairs (a, b) into ``label`` (label[i] <= i, roots fixed)."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return label
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label = nxt


def links_of_prefix(fps: np.ndarray, prefix: int, prefix_bits: int, max_distance: int,
                    limit: int = BLOCK_VARIANTS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the fingerprints that meet on a variant with this prefix."""
    fps = np.unique(fps.astype(np.int64).view(np.uint64))
    rest = BITS - prefix_bits
    radius = max_distance // 2
    top = fps >> np.uint64(rest) if rest < 64 else np.zeros(len(fps), np.uint64)
    spent = np.bitwise_count(top ^ np.uint64(prefix)).astype(np.int64)
    label = np.arange(len(fps), dtype=np.int64)
    low = fps & np.uint64((1 << rest) - 1)
    for keys, own in _variants(low, np.arange(len(fps)), spent, rest, radius, limit):
        ordered = np.sort(keys)
        met = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(met):
            continue
        at = np.minimum(np.searchsorted(met, keys), len(met) - 1)
        hit = np.flatnonzero(met[at] == keys)
        order = np.lexsort((own[hit], keys[hit]))
        k, o = keys[hit][order], own[hit][order]
        same = k[1:] == k[:-1]
        pair = np.unique(o[:-1][same] * len(fps) + o[1:][same])
        a, b = pair // len(fps), pair % len(fps)
        near = np.bitwise_count(fps[a] ^ fps[b]) <= max_distance
        label = _merge(label, a[near], b[near])
    child = np.flatnonzero(label != np.arange(len(fps)))
    return fps[child].view(np.int64), fps[label[child]].view(np.int64)


def linked_fingerprints(distinct: DataFrame, fp: str = "fp", max_distance: int = 4) -> DataFrame:
    """Edges (a, b) whose transitive closure is "reachable by links of at most
    ``max_distance`` bits" among the distinct fingerprints."""
    if max_distance < 0 or max_distance % 2:
        raise ValueError("max_distance must be even: a shared variant at half the distance proves the link")
    spark = distinct.sparkSession
    ship_package(spark)
    ball = sum(math.comb(BITS, i) for i in range(max_distance // 2 + 1))
    n = max(1, distinct.count())
    # Number of prefixes only: enough that one holds about PREFIX_VARIANTS.
    prefix_bits = min(40, max(5, math.ceil(math.log2(n * ball / PREFIX_VARIANTS))))

    def by_prefix(batches):
        import pyarrow as pa
        masks = np.concatenate(flip_masks(prefix_bits, max_distance // 2))
        step = max(1, (1 << 20) // len(masks))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(values), step):
                x = values[i:i + step].astype(np.int64)
                top = x.view(np.uint64) >> np.uint64(BITS - prefix_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((top[:, None] ^ masks[None, :]).ravel().astype(np.int64)),
                     pa.array(np.repeat(x, len(masks)))], names=["prefix", "fp"])

    def forest(key, pdf):
        a, b = links_of_prefix(pdf["fp"].to_numpy(), int(key[0]), prefix_bits, max_distance)
        return pd.DataFrame({"a": a, "b": b})

    rows = distinct.select(F.col(fp).alias("fp")).mapInArrow(by_prefix, "prefix long, fp long")
    return rows.groupBy("prefix").applyInPandas(forest, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                   max_distance: int = 4) -> DataFrame:
    """One row per row of ``docs``: (id, fp, component_id), ``component_id`` the
    smallest id among the rows reachable by links, itself included.

    Null and empty texts have fingerprint 0 and link like any other.  Rows that
    repeat an id are kept as rows; null ids are never a component's id unless
    it has no other.  Other columns are not read."""
    return _groups(docs, id_col, text_col, shingle, max_distance).drop("root")


def _groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_distance: int) -> DataFrame:
    """``simhash_groups`` with ``root``, which is a component's own even where
    components share their smallest id."""
    fps = written(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                               "text", shingle).select("id", "fp"), "simhash-fp")
    reps = written(fps.groupBy("fp").agg(F.min("id").alias("low")), "simhash-distinct")
    cc = connected_components(linked_fingerprints(reps, "fp", max_distance), store=lambda e: written(e, "simhash-links"))
    rooted = reps.join(cc, reps.fp == cc.node, "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id", "root")
    return fps.join(named, "fp").select("id", "fp", "component_id", "root")


def hex_fingerprint(col="fp"):
    """16 lower-case hex digits of a long column."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       max_distance: int = 4) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the
    smallest id stays, with all its columns (rows of a group that repeat that
    id: one of them stays)."""
    g = _groups(docs, id_col, text_col, shingle, max_distance)
    # Per id the rows there are, and those that are their component's first.
    first = F.count_if(F.col("id").eqNullSafe(F.col("component_id")))
    ids = written(g.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), first.alias("firsts"))
                  .where("firsts > 0").select(F.col("id").alias("key"), "rows"), "simhash-first")
    # The input row travels as one column: its names cannot clash with those here.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tagged = packed.join(ids, F.col("id").eqNullSafe(F.col("key"))).drop("key")
    single = tagged.where("rows = 1").select("row.*")
    if ids.where("rows > 1").limit(1).count() == 0:
        return single
    # Rows that share an id are told apart by their component.
    with_fp = fingerprints(tagged.where("rows > 1"), "text", shingle, "fp")
    of_fp = g.select(F.col("fp").alias("known"), "component_id", "root").distinct()
    best = with_fp.join(of_fp, F.col("fp") == F.col("known")).where(F.col("id").eqNullSafe(F.col("component_id")))
    return single.unionByName(best.dropDuplicates(["root"]).select("row.*"))
