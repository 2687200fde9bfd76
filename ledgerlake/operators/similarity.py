"""Sparse cosine similarity join: the ``k`` most similar others of every vector
of a long (owner, feature, weight) table, through an inverted index.

Features are ordered from rare to frequent and vectors have length 1.  If the
part of ``x`` after its first features (its prefix) is shorter than ``t``, a
vector that shares none of the prefix features has a cosine below ``t`` with
``x``.  So two passes are exact:

* Bound.  Owners meet in chunks of a few dozen that share one of their rarest
  features; the k-th best similarity found so is a bound for the owner's final
  one.
* Search.  An owner asks the postings of its prefix under that bound.  Pairs
  that share no prefix feature never meet.

A posting list is cut into parts, and a task multiplies one part of the askers
with one part of the owners: a row per asker and neighbour comes out, never one
per pair.  Owners whose prefix reaches a feature that more than ``hot`` owners
have (dense data, low bounds) skip the index and meet all owners once, in the
large blocks of ``recommend.block_grid``: few copies of a vector, few candidates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import dense_index, materialize
from .recommend import best_rows, block_grid
from .relational import top_k_per_group_split

PART = 1024           # vectors a task compares with as many others
CHUNK = 64            # owners that meet for a bound
RAREST = 3            # of an owner's features are used for its bound
HOT = 8 * PART
_COLUMNS = 2048       # features that are held as a dense block
_ROUND = 1e-9         # of a bound, for sums in another order


def products(a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
    """Dot products of the vectors (features, weights) of two frames."""
    sides = []
    for f in (a, b):
        n = f["features"].map(len).to_numpy()
        sides.append((np.repeat(np.arange(len(f)), n), np.concatenate(f["features"].to_list()), np.concatenate(f["weights"].to_list()), len(f)))
    features = np.intersect1d(sides[0][1], sides[1][1])
    out = np.zeros((len(a), len(b)))
    for at in range(0, len(features), _COLUMNS):
        some = features[at:at + _COLUMNS]
        dense = []
        for row, feature, weight, n in sides:
            place = np.minimum(np.searchsorted(some, feature), len(some) - 1)
            ok = some[place] == feature
            d = np.zeros((n, len(some)))
            d[row[ok], place[ok]] = weight[ok]
            dense.append(d)
        out += dense[0] @ dense[1].T
    return out


def _best(a: pd.DataFrame, b: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` most similar rows of ``b`` for every row of ``a``: positive
    similarities, ties by smaller owner."""
    b = b.sort_values("u", kind="stable").reset_index(drop=True)
    sim = products(a, b)
    ia, ib = a["u"].to_numpy(), b["u"].to_numpy()
    sim[ia[:, None] == ib[None, :]] = 0.0
    best = np.argsort(-sim, axis=1, kind="stable")[:, :k]
    value = np.take_along_axis(sim, best, axis=1)
    r, c = np.nonzero(value > 0)
    return pd.DataFrame({"a": ia[r], "b": ib[best[r, c]], "similarity": value[r, c]})


def vectors(m: DataFrame, owner: str, feature: str, weight: str) -> DataFrame:
    """(u, features, weights, owners) per owner: features numbered from rare to
    frequent, weights of length 1, how many owners have each feature.  Null
    owners, features and weights and zero weights are left out."""
    v = m.select(F.col(owner).alias("u"), F.col(feature).alias("i"), F.col(weight).cast("double").alias("s")).dropna().where("s <> 0")
    known = dense_index(v.groupBy("i").agg(F.count(F.lit(1)).alias("owners")), ["owners", "i"], "f")
    row = F.array_sort(F.collect_list(F.struct("f", "s", "owners")))
    out = v.join(known, "i").groupBy("u").agg(row.alias("row"), F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("norm"))
    return out.select("u", F.col("row.f").alias("features"), F.transform("row.s", lambda s: s / F.col("norm")).alias("weights"),
                      F.col("row.owners").alias("owners"))


def nearest(m: DataFrame, owner: str, feature: str, weight: str, k: int, hot: int = HOT, part: int = PART,
            chunk: int = CHUNK) -> DataFrame:
    """(a, b, similarity, k): the ``k`` most similar others of every owner, by
    cosine (features an owner lacks count as zero); only positive similarities,
    ties by smaller id.  Several weights of a pair must be summed before."""
    vecs = materialize(vectors(m, owner, feature, weight))
    kind = vecs.schema["u"].dataType.simpleString()
    schema = f"a {kind}, b {kind}, similarity double"
    n = vecs.count()

    def parts(size, count, salt):
        """A random part of ``ceil(count / size)`` for a row of ``u``."""
        return F.pmod(F.xxhash64("u", F.lit(salt)), F.greatest(F.ceil(count / size), F.lit(1))).cast("int")

    # Bound: the rarest features of an owner that it shares with anyone.
    rare = vecs.select("*", F.explode(F.slice(F.filter(F.arrays_zip("features", "owners"), lambda x: x["owners"] > 1), 1, RAREST)).alias("x"))
    rare = rare.withColumn("c", parts(chunk, F.col("x.owners"), "bound")).select("u", "features", "weights", F.col("x.features").alias("f"), "c")
    near = rare.groupBy("f", "c").applyInPandas(lambda pdf: _best(pdf, pdf, k), schema)
    near = near.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
    near = top_k_per_group_split(near, ["a"], k, [F.desc("similarity"), F.col("b")], "k")
    bound = near.groupBy("a").agg(F.when(F.count(F.lit(1)) >= k, F.min("similarity")).alias("bound"))

    # The prefix: so many features that the rest is shorter than the bound.
    asked = vecs.join(bound, F.col("u") == F.col("a"), "left").drop("a").withColumn(
        "floor", F.coalesce(F.col("bound"), F.lit(0.0)) * (1 - _ROUND))

    def prefix(features, weights, floors):
        out = []
        for w, floor in zip(weights, floors):
            rest = np.sqrt(np.cumsum((w * w)[::-1])[::-1])      # length from each place on
            out.append(int(np.count_nonzero(rest >= floor)) if floor > 0 else len(w))
        return pd.Series(out, dtype="int32")

    length = F.pandas_udf(prefix, "int")
    asked = materialize(asked.select("u", "features", "weights", "owners", length("features", "weights", "floor").alias("prefix")))
    # Rare to frequent: the last prefix feature has the most owners.
    dense = F.element_at("owners", F.greatest("prefix", F.lit(1))) > hot
    posted = F.explode(F.arrays_zip(F.slice("features", F.lit(1), F.col("prefix")).alias("f"),
                                    F.slice("owners", F.lit(1), F.col("prefix")).alias("n")))
    asks = asked.where(~dense & (F.col("prefix") > 0)).select("u", "features", "weights", posted.alias("x")).where("x.n > 1")
    asks = asks.select("u", "features", "weights", F.col("x.f").alias("f"), F.col("x.n").alias("n"))
    lists = asks.groupBy("f").agg(F.count(F.lit(1)).alias("asks"))
    has = vecs.select("u", "features", "weights", F.explode(F.arrays_zip("features", F.col("owners").alias("n"))).alias("x"))
    has = has.select("u", "features", "weights", F.col("x.features").alias("f"), F.col("x.n").alias("n")).join(lists, "f")
    asks = asks.join(lists, "f")

    def spread(df, own, own_n, other, other_n):
        all_parts = F.sequence(F.lit(0), F.greatest(F.ceil(F.col(other_n) / part), F.lit(1)).cast("int") - 1)
        return df.withColumn(own, parts(part, F.col(own_n), "search")).withColumn(other, F.explode(all_parts)).select(
            *[F.col(c).alias(c) for c in ("u", "features", "weights", "f", "q", "p")])      # both sides stem from one table

    key = ["f", "q", "p"]
    met = spread(asks, "q", "asks", "p", "n").groupBy(*key).cogroup(spread(has, "p", "n", "q", "asks").groupBy(*key))

    def compare(a, b):
        return _best(a, b, k) if len(a) and len(b) else pd.DataFrame({"a": [], "b": [], "similarity": []})

    found = met.applyInPandas(compare, schema).groupBy("a", "b").agg(F.max("similarity").alias("similarity"))

    # Askers who never use the index meet blocks of all owners.
    packed = [F.col("u"), F.col("features").alias("items"), F.col("weights").alias("scores"), F.lit(1.0).alias("norm")]
    many = asked.where(dense & (F.col("prefix") > 0)).select(*packed)
    if not many.isEmpty():
        def in_blocks(a, b):
            ia, ib = a["u"].to_numpy(), b["u"].to_numpy()
            for r, c, value in best_rows(a, b, k):
                yield pd.DataFrame({"a": ia[r], "b": ib[c], "similarity": value})

        cells = vecs.agg(F.sum(F.size("features"))).first()[0]
        found = found.unionByName(block_grid(vecs.select(*packed), many, None, cells, n, in_blocks, schema))
    return top_k_per_group_split(found, ["a"], k, [F.desc("similarity"), F.col("b")], "k")
