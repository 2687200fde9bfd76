"""The sparse similarity join against all pairs, on sparse and dense data."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import similarity as sm


def table_of(spark, cells):
    return spark.createDataFrame([(u, i, s) for (u, i), s in cells.items()], "user string, item string, score double")


def brute(cells, k):
    users = sorted({u for u, _ in cells})
    items = sorted({i for _, i in cells})
    x = np.zeros((len(users), len(items)))
    for (u, i), s in cells.items():
        x[users.index(u), items.index(i)] = s
    sim = x @ x.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
    out = {}
    for a, u in enumerate(users):
        order = sorted((round(-sim[a, b], 9), users[b]) for b in range(len(users)) if b != a and sim[a, b] > 1e-12)[:k]
        out[u] = order
    return out


def clustered(rng, users, groups):
    """Users of a group share rare items; all share a few frequent ones."""
    cells = {}
    for u in range(users):
        g = u % groups
        for _ in range(rng.randint(2, 6)):
            cells[f"u{u:03d}", f"g{g}-{rng.randrange(8)}"] = rng.uniform(1, 5)
        for _ in range(rng.randint(0, 3)):
            cells[f"u{u:03d}", f"all{rng.randrange(4)}"] = rng.uniform(0.1, 1)
    cells["lonely", "only"] = 1.0
    return cells


@pytest.mark.parametrize("k,hot,part,chunk", [(3, 10_000, 1024, 64), (3, 10_000, 7, 4), (3, 20, 16, 8), (50, 0, 16, 8), (1, 40, 32, 2)])
def test_neighbours_of_sparse_users(spark, k, hot, part, chunk):
    cells = clustered(random.Random(1), 90, 9)
    got = {}
    for r in sm.nearest(table_of(spark, cells), "user", "item", "score", k, hot, part, chunk).collect():
        got.setdefault(r.a, []).append((r.k, r.similarity, r.b))
    want = brute(cells, k)
    assert "lonely" not in got
    for u, order in want.items():
        mine = [(round(-s, 9), b) for _, s, b in sorted(got.get(u, []))]
        assert [s for s, _ in mine] == [s for s, _ in order], u
        assert sorted(mine) == sorted(order) or len({s for s, _ in order}) < len(order)


def test_dense_ratings_copies_and_odd_rows(spark):
    rng = random.Random(2)
    cells = {(f"u{u}", f"i{i}"): float(rng.randint(1, 5)) for u in range(30) for i in range(12) if rng.random() < 0.8}
    cells |= {(f"c{u}", f"i{i}"): 2.0 for u in range(25) for i in range(3)}          # copies of one user
    df = table_of(spark, cells).unionByName(spark.createDataFrame(
        [(None, "i1", 1.0), ("u1", None, 1.0), ("zero", "i1", 0.0), ("null", "i1", None)], "user string, item string, score double"))
    rows = sm.nearest(df, "user", "item", "score", 4, 10, 8, 8).collect()
    want = brute(cells, 4)
    assert {r.a for r in rows} == set(want)
    for u, order in want.items():
        assert np.allclose(sorted(-r.similarity for r in rows if r.a == u), [s for s, _ in order], atol=1e-8)
    assert sm.nearest(df.limit(0), "user", "item", "score", 4).count() == 0


def test_users_without_a_common_rare_item_never_meet(spark, monkeypatch):
    """The pairs that tasks multiply stay near the pairs that share a group."""
    rng = random.Random(3)
    cells = {}
    for u in range(400):
        for i in range(6):
            cells[f"u{u}", f"g{u // 10}-{i}"] = 5.0 + rng.random()      # ten users of a group are alike
        cells[f"u{u}", "everyone"] = 0.1
    df = table_of(spark, cells)
    seen = spark.sparkContext.accumulator(0)
    plain = sm._best

    def counted(a, b, k):
        seen.add(len(a) * len(b))
        return plain(a, b, k)

    monkeypatch.setattr(sm, "_best", counted)
    assert sm.nearest(df, "user", "item", "score", 5).groupBy("a").count().where("count = 5").count() == 400
    assert seen.value < 0.15 * 400 ** 2


def test_owners_without_index_meet_in_large_blocks(spark, monkeypatch):
    """One block of 120 owners for parts of 4: no vector travels once per part."""
    rng = random.Random(5)
    cells = {(f"u{u:03d}", f"i{i}"): float(rng.randint(1, 9)) for u in range(120) for i in range(8) if rng.random() < 0.9}
    blocks, real = [], sm.block_grid
    monkeypatch.setattr(sm, "block_grid", lambda *a: blocks.append(a[4]) or real(*a))
    got = {}
    for r in sm.nearest(table_of(spark, cells), "user", "item", "score", 3, 0, 4, 8).collect():
        got.setdefault(r.a, []).append(round(-r.similarity, 9))
    assert blocks == [120]
    for u, order in brute(cells, 3).items():
        assert np.allclose(sorted(got[u]), [s for s, _ in order], atol=1e-8)
