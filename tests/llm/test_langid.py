"""Language identification: fused posterior against numpy, held-out accuracy."""

import math
import random
import re

import numpy as np

from conftest import SF001, SF01
from ledgerlake.llm import langid, queries

SCHEMA = "id long, body binary, is_markup boolean, declared string, host string"


def softmax(x):
    e = np.exp(np.array(x) - max(x))
    return e / e.sum()


def brute(rows, model):
    langs, table = model
    k = len(langs)
    dom = lambda h: ".".join(h.split(".")[-2:])
    sfx = lambda h: h.split(".")[-1]
    ll = {}
    for i, body, markup, _, _ in rows:
        t = body or b""
        ll[i] = langid.log_likelihoods([langid.plain_text(t) if markup else t], table)[0]
    post = {i: softmax(x) for i, x in ll.items()}
    total = (sum(post.values()) + 1) / (len(rows) + k)

    def sums(key):
        out = {}
        for r in rows:
            x = key(r)
            if x is not None:
                s, n = out.get(x, (np.zeros(k), 0))
                out[x] = (s + post[r[0]], n + 1)
        return out

    hosts, doms = sums(lambda r: r[4] or None), sums(lambda r: dom(r[4]) if r[4] else None)

    def given(key):
        t = sums(key)
        tot = sum(s for s, _ in t.values()) if t else 0
        return {x: np.log((s + 1.0) / (tot + len(t))) for x, (s, _) in t.items()}

    sf, de = given(lambda r: sfx(r[4]) if r[4] else None), given(lambda r: r[3])
    out = {}
    for i, _, _, declared, host in rows:
        lp = ll[i].copy()
        if host:
            s, n = doms[dom(host)]
            by = (np.maximum(s - post[i], 0) + langid.PSEUDO * total) / (n - 1 + langid.PSEUDO)
            s, n = hosts[host]
            lp += np.log((np.maximum(s - post[i], 0) + langid.PSEUDO * by) / (n - 1 + langid.PSEUDO)) + sf[sfx(host)]
        else:
            lp += np.log(total)
        if declared is not None:
            lp += de[declared]
        p = softmax(lp)
        out[i] = (langs[int(p.argmax())], float(p.max()), langs[int(ll[i].argmax())])
    return out


def test_fusion_against_numpy(spark):
    rng = random.Random(0)
    langs = ["aa", "bb", "cc"]
    table = np.log(np.random.default_rng(0).dirichlet(np.ones(1 << langid.HASH_BITS), 3).T + 1e-9)
    rows = []
    for i in range(120):
        body = "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 30))).encode()
        markup = rng.random() < 0.5
        rows.append((i, (b"<html lang=xx><p>" + body + b"&amp;</p>") if markup else body, markup,
                     rng.choice([None, "aa", "bb", "zz"]), rng.choice([None, "", "h.x.com", "g.x.com", "y.net", "solo"] + ["hot.com"] * 6)))
    rows += [(200, None, False, None, None), (201, None, True, "aa", "h.x.com")]
    got = {r.id: (r.lang, r.probability, r.text_lang) for r in langid.identify(spark.createDataFrame(rows, SCHEMA), (langs, table)).collect()}
    want = brute(rows, (langs, table))
    assert got.keys() == want.keys()
    for i in want:
        assert got[i][0] == want[i][0] and got[i][2] == want[i][2] and math.isclose(got[i][1], want[i][1], rel_tol=1e-9)


def test_host_and_declaration_decide_short_texts(spark):
    model = langid.train(spark.read.parquet(f"{SF001}/documents.parquet"))
    de = "Der Tag ist schön und die Kinder spielen. ".encode() * 5
    rows = [(i, de, False, "de", "a.example.de") for i in range(30)] + [(100, b"x", False, None, "a.example.de"),
                                                                       (101, b"x", False, "de", None), (102, b"x", False, None, None)]
    got = {r.id: r for r in langid.identify(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert got[0].lang == got[100].lang == got[101].lang == "de"
    assert got[100].probability > got[102].probability


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.train(docs.where("doc_id % 2 = 0"))
    test = docs.where("doc_id % 2 = 1").selectExpr("doc_id AS id", "cast(text AS binary) AS body", "false AS is_markup",
                                                   "cast(null AS string) AS declared", "cast(null AS string) AS host")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = langid.identify(test, model).collect()
    assert len(got) > 400 and np.mean([r.lang == truth[r.id] for r in got]) > 0.95


def test_query_covers_documents_and_pages(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    pages = {r.page_id: re.search('lang="(..)"', r.html)[1] for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    rows = queries.QUERIES["op6_language_id"](spark, SF001).collect()
    assert {r.doc_id for r in rows if r.page_id is None} == set(docs)
    assert {r.page_id for r in rows if r.doc_id is None} == set(pages)
    assert np.mean([r.lang == docs[r.doc_id] for r in rows if r.page_id is None]) > 0.95
    assert np.mean([r.lang == pages[r.page_id] for r in rows if r.doc_id is None]) > 0.95


def test_empty_tables_and_no_languages(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.train(none)
    rows = spark.createDataFrame([(1, b"x", False, None, None)], SCHEMA)
    assert model[0] == [] and langid.identify(rows, model).first().lang is None
    model = langid.train(spark.createDataFrame([(1, "abc", "en"), (2, None, "fr"), (None, "xyz", None)], "doc_id long, text string, lang string"))
    assert model[0] == ["en"]
    assert langid.identify(rows.limit(0), model).collect() == []


def test_declared_language_and_plain_text(spark):
    html = ["<HTML class=a LANG='En-us'>", "<html>", None, "<html lang=>", '<!DOCTYPE html>\n<html\nlang="fr">', "<p lang=de>"]
    df = spark.createDataFrame([(h,) for h in html], "h string")
    assert [r[0] for r in df.select(langid.declared_language("h")).collect()] == ["en", None, None, None, "fr", None]
    assert langid.plain_text(b"<p>a<script>x<y</script>b<!-- <p> -->&eacute;</p>").split() == [b"a", "b é".split()[0].encode(), "é".encode()]
