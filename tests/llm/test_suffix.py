"""Repeated-substring removal against brute force over all substrings."""

import hashlib
import random

import numpy as np
import pytest

from conftest import SF001
from ledgerlake.llm import queries, suffix


def brute(rows, length):
    """rows: (id, text) -> sorted (id, n_bytes, n_removed, n_spans, sha256)."""
    bodies = [(t or "").encode() for _, t in rows]
    seen = {}
    for d, b in enumerate(bodies):
        for i in range(len(b) - length + 1):
            seen.setdefault(hashlib.blake2b(b[i:i + length], digest_size=16).digest(), []).append((d, i))
    cover = [np.zeros(len(b) + 1, dtype=np.int64) for b in bodies]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                cover[d][i] += 1
                cover[d][i + length] -= 1
    out = []
    for (x, _), b, c in zip(rows, bodies, cover):
        gone = np.cumsum(c[:-1]) > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((x, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=repr)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    out = queries.QUERIES["op10_repeated_substrings"](spark, SF001)
    mine = sorted((tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)
    assert mine == brute(rows, 200)
    assert sum(r[2] for r in mine) > 0


def corpus(seed, n=60):
    """Random texts with shared passages at random places, near copies, periods
    and overlaps."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    vocabulary = [word() for _ in range(60)]
    prose = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    shared = [prose(rng.randint(5, 60)) for _ in range(6)]
    texts = [None, "", "x", "ab" * 300, "a" * 500, "a" * 199, "a" * 200]
    for _ in range(n):
        t = prose(rng.randint(1, 80))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            t += s[a:rng.randint(a, len(s))] + prose(rng.randint(0, 10))
        texts.append(t)
    for _ in range(15):
        t = list(rng.choice(texts[7:]) or " ")
        t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    texts += [texts[20]] * 3
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,length,token", [(1, 200, 32), (2, 40, 8), (3, 16, 3), (4, 64, 64), (5, 33, 5)])
def test_random_corpora(spark, seed, length, token):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, token string").repartition(5)
    want = brute(rows, length)
    assert got(suffix.remove_repeats(df, length=length, token=token)) == want
    # Every token hot, or those with more than three runs.
    assert got(suffix.remove_repeats(df, length=length, token=token, hot_runs=seed % 2 * 3)) == want


def test_pieces_do_not_change_the_result(spark, monkeypatch):
    """Cut at arbitrary places, as long texts are, nothing is missed."""
    rows = corpus(9, 20)
    bodies = [(t or "").encode() for _, t in rows]
    for size in (64, 1000, 1 << 21):
        monkeypatch.setattr(suffix, "_PIECE", size)
        suffixes = sorted((d, s + k) for _, _, text, start, n in suffix.run_rows(bodies, 40, 8)
                          for d, s, m in zip(text, start, n) for k in range(m))
        assert suffixes == [(d, i) for d, b in enumerate(bodies) for i in range(len(b) - 39)]


def test_null_and_repeated_ids(spark):
    t = "0123456789" * 3 + "abcdefghij"
    rows = [(None, t), (1, t[:20] + "zz"), (1, "unique text"), (2, None), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(suffix.remove_repeats(df, length=16, token=4)) == brute(rows, 16)


def test_empty_table(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_multikey_groups_with_and_without_shortcut():
    rng = np.random.default_rng(0)
    b = rng.integers(0, 2, 4000, dtype=np.uint8)
    b[1000:1100] = b[3000:3100]
    chars = suffix.eight_byte_chars(b)
    at = np.arange(len(b) - 40)
    group = rng.integers(0, 3, len(at))
    group[2900:3200] = group[900:1200] = 1
    seen = {}
    for i, g in zip(at.tolist(), group.tolist()):
        seen.setdefault((g, bytes(b[i:i + 40])), []).append(i)
    want = np.zeros(len(at), bool)
    for v in seen.values():
        if len(v) > 1:
            want[v] = True
    clash = np.zeros(len(b), np.uint64)          # a shortcut that tells nothing apart
    for short in (None, suffix.token_hashes(b, 40), clash):
        assert (suffix.multikey_groups(chars, at, group, 40, short) == want).all()
    assert want.any()
