"""Cluster metrics over many clusters, k-means on a frame its caller keeps, and
the ends of chains of merges."""

import numpy as np
from pyspark.ml.functions import array_to_vector

from ledgerlake.operators.ml import metrics as mt
from ledgerlake.operators.ml import models as md
from ledgerlake.operators.ml import ward as wd

DIM = 8


def _points(spark, clusters, each=4):
    x = np.random.default_rng(7).normal(size=(clusters * each, DIM)) + np.repeat(np.arange(clusters), each)[:, None]
    rows = [(i, i // each, [float(v) for v in p]) for i, p in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, cluster int, vec array<double>")


def _plan(df):
    return len(df._jdf.queryExecution().logical().toString())


def test_plan_does_not_grow_with_the_clusters(spark):
    few, many = (mt.calinski_harabasz(_points(spark, k)[1], "cluster", "vec", DIM) for k in (3, 300))
    assert _plan(many) < 2 * _plan(few)


def test_many_clusters_against_numpy(spark):
    x, df = _points(spark, 150)
    m = x.reshape(150, 4, DIM).mean(axis=1)
    own = np.repeat(m, 4, axis=0)
    s = np.sqrt(((x - own) ** 2).sum(1)).reshape(150, 4).mean(1)
    d = np.sqrt(((m[:, None] - m[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    want = ((s[:, None] + s[None]) / d).max(1).mean()
    assert abs(mt.davies_bouldin(df, "cluster", "vec", DIM).first()[0] - want) < 1e-9
    b, w = 4 * ((m - x.mean(0)) ** 2).sum(), ((x - own) ** 2).sum()
    want = (b / 149) / (w / (len(x) - 150))
    assert abs(mt.calinski_harabasz(df, "cluster", "vec", DIM).first()[0] / want - 1) < 1e-9


def test_kmeans_leaves_the_callers_frame_stored(spark):
    df = _points(spark, 3)[1].select("id", array_to_vector("vec").alias("features")).persist()
    df.count()
    md.kmeans_best(df, 2, 2)
    assert df.storageLevel.useMemory
    df.unpersist()
    md.kmeans_best(df, 2, 2)
    assert not df.storageLevel.useMemory


def test_long_chains_end_in_few_rounds(spark, monkeypatch):
    n, rounds, real = 300, [], wd._stored
    monkeypatch.setattr(wd, "_stored", lambda df, n: rounds.append(1) or real(df, n))
    chain = spark.createDataFrame([(i, i - 1) for i in range(1, n) if i != 200], "hi long, lo long")
    ends = spark.createDataFrame([(0,), (200,)], "id long")
    got = {r["node"]: r["component"] for r in wd._roots(chain, ends, n).collect()}
    assert got == {i: 0 if i < 200 else 200 for i in range(1, n) if i != 200} and len(rounds) <= 10


def test_search_reads_its_input_once(spark):
    """Every pass of every k reads the stored frame."""
    read = spark.sparkContext.accumulator(0)

    def note(frames):
        for f in frames:
            read.add(len(f))
            yield f

    df = _points(spark, 5)[1].select("id", "vec").mapInPandas(note, "id long, vec array<double>")
    rows = md.kmeans_search(df.select("id", array_to_vector("vec").alias("features")), range(2, 4), n_init=2)
    assert [r[0] for r in rows] == [2, 3] and read.value == 20
