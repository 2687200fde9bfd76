"""Importance resampling against a plain rendering and the SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from conftest import SF001, SF01
from ledgerlake.llm import queries, resample


def lower(t):
    return "".join(c.lower() if c.isascii() else c for c in t)


def plain_features(text, max_n, buckets):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, max_n + 1) for i in range(len(w) - n + 1)], len(w)


def plain(docs, target, max_n, buckets, percent, min_words):
    s = Counter(b for _, t in docs for b in plain_features(t, max_n, buckets)[0])
    t = Counter(b for x in target for b in plain_features(x, max_n, buckets)[0])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        f, n = plain_features(text, max_n, buckets)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in f)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = {id(r): k for k, r in enumerate(able[:percent * len(able) // 100], 1)}
    return sorted(((*r, rank.get(id(r))) for r in out), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("max_n,buckets,percent", [(1, 10_000, 10), (2, 500, 25), (3, 10_000, 100), (1, 7, 0)])
def test_fixture_against_plain_rendering(spark, max_n, buckets, percent):
    docs, bench = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/benchmark.parquet")
    got = resample.resample(docs, bench, max_n=max_n, buckets=buckets, percent=percent)
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()], max_n, buckets, percent, 20)
    assert rows_of(got) == want


def test_query_equals_sql(spark):
    from oracle_harness import duck
    cur = duck(SF01).execute(queries.ORACLE_SQL["op13_importance_resampling"])
    names = [c[0] for c in cur.description]
    want = sorted((tuple(r) for r in cur.fetchall()), key=repr)
    got = queries.QUERIES["op13_importance_resampling"](spark, SF01).select(*names).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


@pytest.mark.parametrize("max_n", [1, 2, 4])
def test_long_texts_are_cut_between_words(monkeypatch, max_n):
    rng = random.Random(2)
    texts = ["", "Ab é1 x" * 50, "w" * 300, " ".join(rng.choice(["Ab", "cÉ", "7", "日本", "--", "o"]) for _ in range(400)), "a b", None]
    monkeypatch.setattr(resample, "PIECE", 40)
    got = {(d, n): Counter() for d in range(len(texts)) for n in range(1, max_n + 1)}
    parts = 0
    for rows, cut, lead in resample.pieces(pa.array(texts), max_n):
        parts += 1
        assert sum(map(len, cut.to_pylist())) < 2 * 400
        for n, at, bucket in resample.grams(cut, lead, max_n, 10_000):
            for d, b in zip(rows[at].tolist(), bucket.tolist()):
                got[d, n][b] += 1
    assert parts > 10
    for d, t in enumerate(texts):
        for n in range(1, max_n + 1):
            whole = Counter(plain_features(t, n, 10_000)[0]) - (Counter(plain_features(t, n - 1, 10_000)[0]) if n > 1 else Counter())
            assert got[d, n] == whole, (d, n)


def test_edge_rows(spark):
    long = "word é " * 12
    rows = [(1, None), (2, ""), (3, "!!"), (None, long), (None, long), (4, long), (4, long.upper()), (5, "A" * 5000), (6, "日 本 " * 15)]
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, `rank` string, id int")
    target = spark.createDataFrame([("word",), (None,), ("",)], "text string")
    got = rows_of(resample.resample(docs, target, max_n=2, buckets=50, percent=60))
    assert [r[:5] for r in got] == [r[:5] for r in plain(rows, ["word", None, ""], 2, 50, 60, 20)]
    assert sorted(r[5] for r in got if r[5]) == [1, 2, 3]
    none = docs.limit(0)
    assert resample.resample(none, target).count() == 0
    assert rows_of(resample.resample(docs, target.limit(0), max_n=1)) == plain(rows, [], 1, 10_000, 10, 20)
    kept = resample.draw(docs, target, percent=100)
    assert kept.columns == docs.columns and kept.count() == 5
