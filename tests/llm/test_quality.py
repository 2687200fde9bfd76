"""Quality rules: counts against a plain rendering, classifier held out."""

import random
import re

import numpy as np

from conftest import SF001, SF01
from ledgerlake.llm import quality, queries


def plain_counts(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


def test_query_counts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = queries.QUERIES["op8_quality_rules"](spark, SF001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        c = plain_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c
        assert r.base_failed == (c[0] < 20 or 100 * c[4] > 30 * c[0])
        assert not (r.base_failed and r.kept)


def test_odd_texts():
    rng = random.Random(3)
    texts = [None, "", " ", "a", "é  x\x1cy", "a\n\na\n \n a\na\r\nb", "#*$%&|<>", "😀" * 3]
    texts += [" ".join(rng.choice("abc") for _ in range(n)) for n in (7, 8, 9, 16, 40, 200)]
    texts += ["a b c d e f g h " * 5, "x\n" * 30]
    for t in texts:
        assert quality.base_counts(t.encode() if t is not None else None) == plain_counts(t), t


def test_batched_margins_equal_single_texts():
    rng = np.random.default_rng(1)
    w = rng.normal(size=quality.FAMILIES << quality.HASH_BITS)
    texts = [b"", b" ", b"ab", b"one two", "é x\n日本 語".encode(), b"longer words here, and more of them " * 40, b"x"]
    many = quality.margins(texts, w, 0.5)
    for t, m in zip(texts, many):
        assert abs(m - quality.margins([t], w, 0.5)[0]) < 1e-9
        i, v = quality.sparse_features(t)
        assert abs(m - (0.5 + (w[i] * v).sum())) < 1e-9


def test_words_are_told_apart_by_all_their_bytes():
    """Words of one length that differ after their eighth byte are different
    1-grams and 2-grams; a word is the same wherever it stands."""
    words = "internationally internationalists internationalised internationalized собака1 собака2 記号変数 記号変換".split()
    words += ["abcdefgh" + x + y for x in "pqrstuvw" for y in "pqrstuvw"]
    one = [quality.ngrams([w.encode()])[0][0].tolist() for w in words]
    assert all(len(x) == 1 for x in one)
    assert len({x[0] for x in one}) == len(words)
    two = {quality.ngrams([f"the {w}".encode()])[1][0].tolist()[0] for w in words}
    assert len(two) == len(words)
    joined = quality.ngrams([b"", " ".join(words).encode(), b"x", "\n".join(words[::-1]).encode()])[0]
    assert joined[0][joined[1][1]:joined[2][1]].tolist() == [x[0] for x in one]
    assert joined[0][joined[1][3]:joined[2][3]].tolist() == [x[0] for x in one[::-1]]


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    train = labels.where("doc_id % 3 <> 0")
    test = {r.doc_id: r.quality for r in labels.where("doc_id % 3 = 0").collect()}
    rows = [r for r in quality.quality_rules(docs, train).collect() if r.doc_id in test]
    right = [(r.probability >= 0.5) == (test[r.doc_id] == 1) for r in rows]
    assert len(rows) > 100 and np.mean(right) > 0.95
    brier = np.mean([(r.probability - test[r.doc_id]) ** 2 for r in rows])
    assert brier < 0.06
    good = [r for r in rows if test[r.doc_id] == 1 and not r.base_failed]
    assert np.mean([r.kept for r in good]) > 0.97


def test_without_labels_nulls_and_clashes(spark):
    text = " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, "x", 1.0), (2, None, None, None), (None, text, "k", 0.0), (3, "short", "x", 0.0), (1, text, "x", 1.0)],
                                 "doc_id long, text string, kept string, probability double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    nulls = spark.createDataFrame([(1, None), (None, 1), (3, 1)], "doc_id long, quality int")
    for labels in (none, nulls):
        rows = quality.quality_rules(docs, labels).collect()
        assert sorted((r.doc_id or 0, r.kept) for r in rows) == [(0, True), (1, True), (1, True), (2, False), (3, False)]
        kept = quality.keep_good(docs, labels)
        assert kept.columns == docs.columns and kept.count() == 3
    empty = docs.limit(0)
    assert quality.quality_rules(empty, none).collect() == []


def test_very_long_text():
    t = " ".join(f"w{i}" for i in range(400_000)).encode()
    assert quality.base_counts(t)[0] == 400_000
    assert len(quality.margins([t, b"x"], np.ones(quality.FAMILIES << quality.HASH_BITS), 0.0)) == 2
