"""Relational building blocks: shares, counters, top-k, profiles (A, T, J)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import materialize

# Groups whose table every task gets whole.
BROADCAST_GROUPS = 10_000


def join_groups(df: DataFrame, stats: DataFrame, key: str, rows: str = "_rows", limit: int = BROADCAST_GROUPS) -> DataFrame:
    """Left join of ``stats`` (one row per group, ``rows`` = the group's rows in
    ``df``) on ``key``, by which no task reads a whole large group.

    At most ``limit`` groups go to every task and ``df`` is not shuffled.  Of
    more groups only those with over a ``limit``-th of all rows (fewer than
    ``limit``) and the null key do so; the other rows are shuffled by key."""
    stats = materialize(stats.where(F.col(key).isNotNull()))
    n, total = stats.agg(F.count(F.lit(1)), F.sum(rows)).first()
    if n <= limit:
        return df.join(F.broadcast(stats.drop(rows)), key, "left")
    large = F.col(rows) > (total or 0) / limit
    hot = F.broadcast(stats.where(large).select(key))
    spread = df.where(F.col(key).isNull()).unionByName(df.join(hot, key, "left_semi"))
    rest = df.where(F.col(key).isNotNull()).join(hot, key, "left_anti")
    return spread.join(F.broadcast(stats.where(large).drop(rows)), key, "left").unionByName(
        rest.join(stats.where(~large).drop(rows), key, "left"))


def share_table(df: DataFrame, key, count_col: str = "count", pct_col: str = "pct",
                drop_null: bool = False, digits: int = 2) -> DataFrame:
    """Count and percent per key (``value_counts`` with ``normalize``).

    The grouped counts are one aggregate; the total is their sum, fetched as
    a single scalar (no keyless window over a possibly large key table)."""
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    total = g.agg(F.sum(count_col)).first()[0] or 0
    g = g.withColumn(pct_col, F.round(F.col(count_col) * 100.0 / F.lit(max(total, 1)), digits))
    if drop_null:
        for k in keys:
            g = g.where(F.col(k if isinstance(k, str) else str(k)).isNotNull())
    return g


def top_k_per_group_split(df: DataFrame, keys: Sequence[str], k: int, order: Sequence[Column],
                          rank_col: str = "rank", salts: int = 16) -> DataFrame:
    """Exact top-k per group that survives a hot group: rank first inside
    (group, salt) buckets, keep k per bucket, then rank the at most
    k * salts survivors per group.  Any row of the group's top k is in the top
    k of its bucket, so the result is exact."""
    salt = F.abs(F.xxhash64(*[F.col(c) for c in df.columns])) % salts
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    stage = df.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return stage.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k).drop("_salt", "_r1")
