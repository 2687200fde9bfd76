"""Connected components of an edge table by alternating star contractions.

Each round is two grouped minima and two joins; no neighbour list is ever
collected, so a hub with millions of links is an ordinary (split) join key.
The edge table is materialised after every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import materialize


def _stats(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", store=materialize) -> DataFrame:
    """(node, component) for every node of ``edges`` that has a link to
    another node; ``component`` is the smallest node reachable.

    Null ends and self links carry no connection and are left out; repeated
    edges count once.  Loops until a round changes nothing.  ``store`` cuts the
    lineage of a round's edges."""
    e = (edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = store(e)
    before = _stats(e)
    while before[0]:
        # Larger neighbours of every node move to the smallest node around it.
        both = e.select(F.col("u").alias("s"), F.col("v").alias("d")).union(e.select("v", "u"))
        low = both.groupBy("s").agg(F.min("d").alias("m")).select("s", F.least("s", "m").alias("m"))
        big = both.join(low, "s").where("d > s").select(F.col("d").alias("u"), F.col("m").alias("v")).distinct()
        # Every node and its smaller neighbours move to the smallest of them.
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = store(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        after = _stats(e)
        if after == before:
            break
        before = after
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
