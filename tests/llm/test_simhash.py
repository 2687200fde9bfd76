"""SimHash groups against brute force: naive fingerprints, all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from conftest import SF001
from ledgerlake.llm import simhash
from ledgerlake.operators.graph import connected_components


def naive_fp(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")))
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def naive_groups(rows, k=4, d=4):
    """rows: (id, text) -> list of (id, fp, component)."""
    fps = [naive_fp(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= d:
                root[find(i)] = find(j)
    low = {}
    for i, (x, _) in enumerate(rows):
        if x is not None:
            r = find(i)
            low[r] = min(low.get(r, x), x)
    return sorted(((x, fps[i], low.get(find(i))) for i, (x, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted(((r.id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=repr)


def test_query_against_all_pairs(spark):
    from ledgerlake.llm.queries import QUERIES
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    out = QUERIES["op1_simhash_dedup"](spark, SF001)
    rows = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in out.collect()), key=repr)
    assert rows == naive_groups(docs)
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in out.collect())


def test_edge_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(90_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE  two"), (6, long), (7, long + " end"),
            (7, "repeated id"), (7, "repeated id"), (None, "no id"), (8, "Éa\u00a0b c"), (9, "É a")]
    df = spark.createDataFrame([(x, t, "clash", 1) for x, t in rows], "doc_id long, text string, fp string, component_id int")
    assert got(simhash.simhash_groups(df)) == naive_groups(rows)
    kept = simhash.keep_one_per_group(df)
    assert kept.columns == df.columns
    comps = {c for _, _, c in naive_groups(rows)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(i) for i in comps)


def test_rows_that_share_an_id_are_kept_by_their_own_group(spark):
    """Id 7 is a copy of 3 and another text besides; null ids are a copy of 4, a
    text of their own twice, and another; id 9 is two unrelated texts."""
    text = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcdefg"}
    rows = [(3, "a"), (7, "a"), (7, "b"), (4, "c"), (None, "c"), (None, "d"), (None, "d"), (None, "e"), (9, "f"), (9, "g")]
    df = spark.createDataFrame([(i, text[k], k) for i, k in rows], "doc_id long, text string, kind string")
    kept = simhash.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.kind) for r in kept.collect()) == [
        (0, "d"), (0, "e"), (3, "a"), (4, "c"), (7, "b"), (9, "f"), (9, "g")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df).collect() == []
    assert simhash.keep_one_per_group(df).collect() == []


def test_chain_and_ball_of_fingerprints(spark):
    """A chain of 4-bit steps is one component end to end, 5-bit steps link
    nothing, and a crowded ball costs no more edges than members."""
    rng = random.Random(5)
    chain = [0]
    for i in range(15):
        chain.append(chain[-1] ^ (0b1111 << (4 * i)))
    far = [rng.getrandbits(64) for _ in range(40)]
    far += [f ^ 0b11111 << 20 for f in far]
    ball = [rng.getrandbits(64)]
    ball += [ball[0] ^ (1 << i) ^ (1 << j) for i in range(0, 40) for j in range(i)]
    fps = sorted(set(chain + far + ball))
    signed = [simhash._signed(f) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.linked_fingerprints(df, "fp", 4)
    comp = {r.node % (1 << 64): r.component for r in connected_components(edges).collect()}
    assert len({comp[c] for c in chain}) == 1
    assert len({comp[c] for c in ball}) == 1
    assert not any(f in comp for f in far)
    assert edges.count() < 29 * len(fps)


@pytest.mark.parametrize("limit", [64, 5000, 1 << 21])
def test_blocks_do_not_change_links(limit):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    near = [b ^ np.uint64((1 << int(i)) | (1 << int(j))) for b in base for i, j in rng.integers(0, 64, (4, 2))]
    fps = np.unique(np.array([*base, *near], dtype=np.uint64)).view(np.int64)
    pairs = set()
    for prefix in range(32):
        a, b = simhash.links_of_prefix(fps, prefix, 5, 4, limit)
        pairs |= set(zip(a.tolist(), b.tolist()))
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        root[find(a)] = find(b)
    u = fps.view(np.uint64)
    true = {int(f): int(f) for f in fps}

    def tfind(x):
        while true[x] != x:
            x = true[x]
        return x
    for i in range(len(u)):
        for j in range(i):
            if bin(int(u[i]) ^ int(u[j])).count("1") <= 4:
                true[tfind(int(fps[i]))] = tfind(int(fps[j]))
    groups = lambda f: {frozenset(x for x in root if f(x) == r) for r in {f(x) for x in root}}
    assert groups(find) == groups(tfind)


def test_odd_distance_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.linked_fingerprints(spark.createDataFrame([(1,)], "fp long"), "fp", 3)
