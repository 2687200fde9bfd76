"""Periodic runs against a rendering that tries every lag at every place."""

import hashlib
import random
import re
import zlib

import pytest

from conftest import SF001
from ledgerlake.llm import periodic, queries


def plain_runs(w, min_length=6, min_exponent=4):
    out = []
    for q in range(1, len(w)):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            part = w[i:j + q]
            if len(part) >= max(min_length, min_exponent * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, len(part), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def noisy(rng, n, letters):
    w = [rng.choice("abcdefgh"[:letters]) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        a, p = rng.randrange(max(n, 1)), rng.randint(1, 12)
        for i in range(a + p, rng.randint(a, n) if n else 0):
            w[i] = w[i - p]
    return w


@pytest.mark.parametrize("least,exponent", [(6, 4), (1, 2.5), (3, 3), (20, 4), (6, 2.2)])
def test_all_runs_of_random_texts(least, exponent):
    rng = random.Random(7)
    found = 0
    for _ in range(120):
        docs = [noisy(rng, rng.choice([0, 1, 5, 6, 7, 30, 80, 150]), rng.choice([1, 2, 3, 8])) for _ in range(rng.randint(1, 6))]
        got = [(n, r) for n, r, _ in periodic.search([" ".join(w).encode() for w in docs], least, exponent)]
        want = [(len(w), plain_runs(w, least, exponent)) for w in docs]
        assert got == want
        found += sum(len(r) for _, r in want)
    assert found > 50
    with pytest.raises(ValueError):
        periodic.word_runs(*periodic.split_words([b"a b"])[:2], 6, 2)


def test_texts_of_a_slice_stay_apart(monkeypatch):
    texts = [b"a a a", b"a a a a a a", b"", b"\x0b", b"a b a b a b a", b"b a b a b"]
    alone = [list(periodic.search([t], 6, 4))[0] for t in texts]
    assert list(periodic.search(texts, 6, 4)) == alone
    monkeypatch.setattr(periodic, "PIECE", 4)
    assert list(periodic.search(texts, 6, 4)) == alone


def test_long_and_wide_texts():
    block = [f"w{i}" for i in range(5000)]
    words = ["x"] * 3000 + block * 4 + ["y", "z"] * 40000
    (n, runs, kept), = periodic.search([" ".join(words).encode()], 6, 4)
    assert n == len(words)
    assert runs == [(0, 3000, 1), (3000, 20000, 5000), (23000, 80000, 2)]
    assert kept == " ".join(["x", *block, "y", "z"]).encode()


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def digest(w, runs):
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_plain_rendering(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_periodic_runs"](spark, SF001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    runs = 0
    for r in rows:
        w = planted(r.doc_id, docs[r.doc_id])
        if len(w) > 3000:
            continue        # the plain rendering is quadratic
        assert tuple(r[c] for c in COLUMNS) == digest(w, plain_runs(w)), r.doc_id
        runs += r.n_runs
    assert runs >= 10


def test_edge_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \t\r\n"), (None, "a b c " * 9), (None, "a b c " * 9), (4, "é日 " * 8), (4, "one two"),
            (5, "x\x1fy\xa0z " * 7), (12, "a b c d e f")]
    docs = spark.createDataFrame([(i, t, 9, 8, 7) for i, t in rows],
                                 "doc_id long, text string, runs int, collapsed int, `n_words` int")
    got = periodic.find_runs(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        texts = [t for i, t in rows if i == r.id]
        assert any((r.n_words, [tuple(x) for x in r.runs]) == (len((t or "").encode().split()), plain_runs((t or "").encode().split()))
                   for t in texts)
    assert [r.collapsed for r in got if r.id is None] == ["a b c"] * 2
    kept = periodic.drop_repeats(docs)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.text) for r in kept.collect()} == {
        (1, None), (2, ""), (3, " \t\r\n"), (None, "a b c"), (4, "é日"), (4, "one two"), (5, "x\x1fy\xa0z"), (12, "a b c d e f")}
    empty = docs.limit(0)
    assert periodic.find_runs(empty).count() == 0 and periodic.drop_repeats(empty).count() == 0
    # The query: texts without words keep no plants.
    path = str(tmp_path)
    docs.select("doc_id", "text").write.parquet(f"{path}/documents.parquet")
    for r in queries.QUERIES["op12_periodic_runs"](spark, path).collect():
        assert any(tuple(r[c] for c in COLUMNS) == digest(w, plain_runs(w))
                   for w in (planted(i, t) if i is not None else re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in rows if i == r.doc_id))
