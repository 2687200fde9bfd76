"""Lexicon tables: the automaton, whole and in shards, against a plain scan."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import lexicon as lx
from ledgerlake.operators import text as tx


def plain(text, entries, min_len=2):
    """Longest word at the leftmost place, one character at a time."""
    out, i = [], 0
    longest = max(map(len, entries), default=0)
    while i < len(text):
        n = next((n for n in range(min(longest, len(text) - i), 0, -1) if text[i:i + n] in entries), 0)
        if n:
            out.append(text[i:i + n])
        i += n or 1
    return [w for w in out if len(w) >= min_len and "stop" not in entries[w]]


def run(spark, texts, rows, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    words = spark.createDataFrame(rows, "word string, kind string, weight int")
    return {r.id: r for r in lx.analyse_with(df, "body", words, **options).collect()}


def entries_of(rows):
    out = {}
    for w, k, v in rows:
        if w:
            out.setdefault(w, {})[k] = v
    return {w: k for w, k in out.items() if set(k) != {"stop"}}


@pytest.mark.parametrize("limit,shard", [(200_000, 200_000), (0, 40)])
def test_tokens_against_plain_scan(spark, limit, shard):
    rng = random.Random(1)
    rows = [("".join(rng.choice("abé日") for _ in range(rng.randint(1, 5))), rng.choice(["positive", "negative", "sector", "stop"]), rng.randint(-3, 3))
            for _ in range(200)] + [(None, "positive", 1), ("", "negative", 1)]
    texts = [None, "", "z"] + ["".join(rng.choice("abé日 z") for _ in range(rng.randint(0, 80))) for _ in range(60)]
    entries = entries_of(rows)
    got = run(spark, texts, rows, broadcast_words=limit, shard_words=shard)
    for i, t in enumerate(texts):
        want = plain(t or "", entries)
        assert got[i].tokens == want, t
        assert got[i].sector_keywords == [w for w in want if "sector" in entries[w]]
        assert got[i].sentiment_keywords == [w for w in want if {"positive", "negative"} & set(entries[w])]
        assert got[i].sentiment_score == got[i].positive_score - got[i].negative_score


def test_equals_the_parameter_lexicon(spark):
    words = [*tx.POSITIVE_WORDS_ZH, *tx.NEGATIVE_WORDS_ZH, *tx.SECTOR_WORDS_ZH, *tx.STOP_WORDS_ZH, "，", "x"]
    rng = random.Random(2)
    df = spark.createDataFrame([(i, "".join(rng.choice(words) for _ in range(30))) for i in range(80)] + [(99, "")], "id int, body string")
    want = tx.analyse(df, "body", tx.FINANCE_ZH)
    got = lx.analyse_with(df, "body", lx.lexicon_table(spark, tx.FINANCE_ZH)).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hundred_thousand_words(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 9))) for _ in range(100_000)}
    rows = [(w, "positive", 1) for w in sorted(words)]
    texts = [" ".join(rng.sample(sorted(words), 3)) + " qqq" for _ in range(20)]
    for options in ({}, {"broadcast_words": 10, "shard_words": 30_000}):
        got = run(spark, texts, rows, **options)
        for i, t in enumerate(texts):
            assert got[i].tokens == plain(t, dict.fromkeys(words, {}))


def test_empty_lexicon_and_clashing_columns(spark):
    df = spark.createDataFrame([("a b", "mine", 3)], "body string, tokens string, row int")
    none = spark.createDataFrame([], "word string, kind string, weight int")
    r = lx.analyse_with(df, "body", none).first()
    assert r.tokens == [] and r.polarity == "neutral" and r["row"] == 3
    assert lx.analyse_with(df.limit(0), "body", none).count() == 0
    assert lx.analyse_with(df.where(F.lit(False)), "body", none).columns.count("tokens") == 1
