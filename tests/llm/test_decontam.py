"""Decontamination against brute force: full edit-distance alignment."""

import random
import re

import numpy as np

from conftest import SF001
from ledgerlake.llm import decontam, queries


def norm(t):
    return re.sub("[\\W_]+", " ", t.lower()).strip(" ")


def least_edits(doc, windows):
    """Sellers: least edits of each window (a row) against any stretch of doc."""
    n, m = windows.shape
    col = np.tile(np.arange(m + 1), (n, 1))
    best = col[:, -1].copy()
    for ch in doc.tolist():
        new = np.zeros_like(col)
        new[:, 1:] = np.minimum(col[:, :-1] + (windows != ch), col[:, 1:] + 1)
        new = np.minimum.accumulate(new - np.arange(m + 1), axis=1) + np.arange(m + 1)
        col = new
        best = np.minimum(best, col[:, -1])
    return best


def brute(docs, items):
    """Every window of 80 characters at every place of an item, at most one edit
    for 20 characters; items under 32 characters as whole words."""
    out = set()
    for d, t in docs:
        a = decontam.normalise(t or "")
        for i, x in items:
            w = decontam.normalise(x or "")
            if not len(w):
                continue
            if len(w) < 32:
                hit = f" {norm(x)} " in f" {norm(t or '')} "
            else:
                m = min(80, len(w))
                hit = (least_edits(a, np.lib.stride_tricks.sliding_window_view(w, m)) <= m // 20).any()
            if hit:
                out.add((d, i))
    return out


def prose(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "é", "an", "re", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edited(rng, t, k):
    a = list(t)
    for _ in range(k):
        i, kind = rng.randrange(len(a)), rng.randrange(3)
        if kind == 0:
            a[i] = "q"
        elif kind == 1:
            a.insert(i, "z")
        else:
            del a[i]
    return "".join(a)


def test_against_full_alignment(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(4, 60)).capitalize()) for i in range(14)] + [(90, None), (91, ""), (92, "short item"), (93, "zz"), (94, "?!"), (95, "What is the capital of France?")]
    docs = []
    for d in range(90):
        t = prose(rng, rng.randint(0, 40))
        if d % 3:
            x = rng.choice(items[:14])[1]
            if d % 5 == 0:
                a = rng.randint(0, len(x) // 2)
                x = x[a:]
            t = t + " " + edited(rng, x, rng.randint(0, 14)).upper().replace(" ", rng.choice([" ", "  ", "\n", ", "])) + " " + prose(rng, 20)
        docs.append((d, t))
    docs += [(500, None), (501, ""), (502, items[0][1][:len(items[0][1]) // 2]), (503, items[0][1][len(items[0][1]) // 2:])]
    docs += [(510, "a Short, item."), (511, "short items"), (512, "zz"), (513, "zzz z"), (514, "WHAT is the capital of france"), (515, "what is the capital of")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, item_id int, edits string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 15
    for block in (decontam.BLOCK_CHARS, 300):
        got = {(r.doc_id, r.item_id) for r in decontam.find_contamination(df, bench, block_chars=block).collect()}
        assert got == want
    kept = decontam.drop_contaminated(df, bench, block_chars=600)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d, _ in docs} - {d for d, _ in want})


def test_long_text_is_searched_to_its_end(monkeypatch):
    rng = random.Random(8)
    item = prose(rng, 40)
    idx = decontam.build_index([(7, item), (8, "tiny word"), (9, "hon")])
    text = prose(rng, 2000) + " " + item + " " + prose(rng, 500) + " " + item + " wordless tiny words a tiny word xhon honx"
    whole = [r[1] for r in decontam.leaks_of([1], [text], [idx])]
    assert whole == ([7, 8, 9] if " hon " in f" {norm(text)} " else [7, 8])
    for piece in (120, 150, 1000, 5000):
        monkeypatch.setattr(decontam, "_PIECE", piece)
        rows = decontam.leaks_of([1], [text], [idx])
        assert [r[1] for r in rows] == whole
        _, _, edits, first, place, n = rows[0]
        assert edits == 0 and n == 80
        assert norm(text)[first:first + 80] == norm(item)[place:place + 80]
    first = rows[whole.index(8)][3]
    assert f" {norm(text)} "[first:first + 11] == " tiny word "


def test_every_verbatim_part_is_found():
    """Parts of 80 characters and more from any place of an item."""
    rng = random.Random(12)
    items = [(i, prose(rng, rng.randint(14, 90))) for i in range(30)]
    idx = [decontam.build_index(items)]
    texts, want = [], []
    for n in (80, 81, 90, 100, 110, 150):
        for _ in range(60):
            i, x = rng.choice([(i, norm(x)) for i, x in items if len(norm(x)) >= n])
            a = rng.randint(0, len(x) - n)
            texts.append(prose(rng, 30) + "x" + x[a:a + n] + "x" + prose(rng, 30))
            want.append(i)
    got = {(d, i) for d, i, *_ in decontam.leaks_of(list(range(len(texts))), texts, idx)}
    assert all((d, i) in got for d, i in enumerate(want))


def test_many_items_with_one_template_in_bounded_slices(monkeypatch):
    rng = random.Random(13)
    template = prose(rng, 30)[:108]
    items = [(i, template + " " + prose(rng, 8)) for i in range(300)]
    idx = [decontam.build_index(items)]
    texts = [prose(rng, 40), prose(rng, 10) + " " + template + " " + prose(rng, 10), prose(rng, 60) + " " + items[7][1]]
    whole = decontam.leaks_of([0, 1, 2], texts, idx)
    assert {(d, i) for d, i, *_ in whole} == {(d, i) for d in (1, 2) for i in range(300)}
    most = []
    plain = decontam._verified
    monkeypatch.setattr(decontam, "_verified", lambda c, o, i, p, q: (most.append(len(p)), plain(c, o, i, p, q))[1])
    monkeypatch.setattr(decontam, "HITS", 3000)
    cut = decontam.leaks_of([0, 1, 2], texts, idx)
    assert {r[:3] for r in cut} == {r[:3] for r in whole} and max(most) <= 3000 and len(most) > 10


def test_normal_form():
    for t in ["", " ", "A  b,,C!", "...x", "É_é\nß²", "a b"]:
        assert "".join(map(chr, decontam.normalise(t))) == norm(t), t


def test_query_finds_planted_items(spark):
    docs = [(r.doc_id, norm(r.text)) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r.item_id, norm(r.text)) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    exact = {(d, i) for d, t in docs for i, x in items if f" {x} " in f" {t} "}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op2_decontamination"](spark, SF001).collect()}
    assert exact and exact <= got
    assert len({d for d, _ in got}) <= 0.1 * len(docs)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert decontam.find_contamination(docs, bench).collect() == []
    assert decontam.find_contamination(some, bench).collect() == []
    assert decontam.drop_contaminated(some, bench).count() == 1
