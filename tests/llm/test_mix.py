"""Pfair mixing: deviation below one block, whole results, brute positions."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from conftest import SF001
from ledgerlake.llm import mix, queries


def plain_schedule(weights, slots):
    """Slot by slot: the released block of the earliest deadline, in exact
    fractions; (source, block) of every slot."""
    total = sum(map(Fraction, weights.values()))
    w = {s: Fraction(x) / total for s, x in weights.items()}
    done = dict.fromkeys(w, 0)
    out = []
    for t in range(slots):
        s = min((s for s in w if math.floor(done[s] / w[s]) <= t), key=lambda s: (math.ceil((done[s] + 1) / w[s]), s))
        out.append((s, done[s]))
        done[s] += 1
        assert all(abs(done[x] - (t + 1) * w[x]) < 1 for x in w)
    return out


def slots_of(rows):
    return {(r.s, r.first + k): t for r in rows for k, t in enumerate(r.slots)}


@pytest.mark.parametrize("seed,range_slots", [(0, 1000), (1, 100), (2, 7), (3, 64), (4, 1), (5, 333)])
def test_ranges_give_the_schedule_of_one_run(spark, seed, range_slots):
    rng = random.Random(seed)
    w = [rng.choice([0.001, 1, 3, 50]) * rng.random() + 1e-6 for _ in range(rng.randint(1, 40))]
    n = 400 if range_slots > 1 else 40
    got = slots_of(mix.schedule(spark, mix.exact_weights(w), n, range_slots).collect())
    want = plain_schedule(dict(enumerate(w)), n)
    assert got == {x: t for t, x in enumerate(want)}


def test_exact_weights():
    assert mix.exact_weights([0.5, 0.25, 0.25]) == [2, 1, 1]
    w = [1e-9, 0.3, 7.0]
    c = mix.exact_weights(w)
    assert all(Fraction(a) * c[1] == Fraction(w[1]) * b for a, b in zip(w, c))
    for bad in ([], [0], [-1], [float("nan")], [float("inf")]):
        with pytest.raises(ValueError):
            mix.exact_weights(bad)


def test_tiny_weight_and_a_million_blocks():
    """Below one block of the weights as given at every slot, over many ranges
    whose borders come from the range before."""
    w = [0.6, 0.39, 0.01 - 1e-6, 1e-6]
    c = mix.exact_weights(w)
    total, taken, ahead, changed = sum(c), np.zeros(4, dtype=np.int64), [], 0
    for begin in range(0, 1_000_000, 100_000):
        changed += ahead != mix.guess_ahead(c, total, begin)
        of, ahead = mix.run_range(c, total, begin, begin + 100_000, ahead)
        counts = np.cumsum(of[:, None] == np.arange(4), axis=0) + taken
        share = (begin + 1 + np.arange(100_000))[:, None] * (np.array(c, dtype=float) / total)
        assert np.abs(counts - share).max() < 1 + 1e-9      # shares are rounded here
        taken = counts[-1]
    assert taken[3] == 1


def check(rows, docs, block_chars, weights=None):
    """rows: mixture rows; docs: (id, source, size)."""
    assert {r.doc_id for r in rows} == {d for d, _, _ in docs}
    chars = Counter()
    for _, s, n in docs:
        chars[s or ""] += n
    weights = weights or {s: n ** mix.ALPHA for s, n in chars.items()}
    size = {d: n for d, _, n in docs}
    first = defaultdict(list)
    for r in rows:
        if r.mix_epoch == 0:
            first[r.mix_source].append((r.mix_offset, size[r.doc_id], r.doc_id))
    for s, of in first.items():        # documents fill their source without gaps
        of.sort()
        assert sum(n for _, n, _ in of) == chars[s]
        assert all(a + n == b for (a, n, _), (b, _, _) in zip(of, of[1:])) and of[0][0] == 0
    blocks = {s: -(-n // block_chars) for s, n in chars.items()}
    longest = max(math.ceil(blocks[s] * sum(map(Fraction, weights.values())) / Fraction(weights[s])) for s in blocks)
    at, done = {}, Counter()
    for t, (s, j) in enumerate(plain_schedule(dict(sorted(weights.items())), longest)):
        if all(done[s] >= blocks[s] for s in blocks):
            break
        at[t] = (s, j)
        done[s] += 1
    have = defaultdict(set)
    for r in rows:
        s, j = at[r.mix_slot]
        assert s == r.mix_source and j == r.mix_block + r.mix_epoch * blocks[s]
        assert r.mix_block == r.mix_offset // block_chars
        have[r.doc_id].add(r.mix_epoch)
    for s, of in first.items():
        for o, _, d in of:
            j = o // block_chars
            assert have[d] == {e for e in range(done[s]) if j + e * blocks[s] < done[s]}


def test_query(spark):
    docs = [(r.doc_id, r.source, len(r.text or "") + 1) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows = queries.QUERIES["op3_source_mixing"](spark, SF001).withColumnRenamed("source", "mix_source").collect()
    check(rows, docs, mix.BLOCK_CHARS)


def test_hot_null_and_tiny_sources(spark, monkeypatch):
    monkeypatch.setattr(mix, "BUCKET_ROWS", 16)
    rng = random.Random(2)
    rows = [(i, "x" * rng.randint(0, 300), rng.choice(["hot"] * 6 + ["a", "b", None])) for i in range(400)]
    rows += [(400, None, "one"), (401, "y" * 5000, "a")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, source string, mix_slot string, n int")
    docs = [(d, s, len(t or "") + 1) for d, t, s in rows]
    check(mix.mix_sources(df, block_chars=500).collect(), docs, 500)
    w = {"hot": 0.2, "a": 0.3, "b": 0.3, "": 0.15, "one": 0.05}
    check(mix.mix_sources(df, w, block_chars=500).collect(), docs, 500, w)
    out = mix.mixed_rows(df.drop("mix_slot"), w, block_chars=500)
    assert out.columns == ["doc_id", "text", "source", "n"]
    order = [r.doc_id for r in out.collect()]
    want = [r.doc_id for r in sorted(mix.mix_sources(df, w, block_chars=500).collect(), key=lambda r: (r.mix_slot, r.mix_offset))]
    assert order == want
    size = Counter()
    for r in out.collect():
        size[r.source or ""] += len(r.text or "") + 1
    total = sum(size.values())
    assert all(abs(size[s] / total - w[s]) < 0.06 for s in w)


def test_deviation_from_the_weights_as_given(spark):
    """A weight below a thousandth and thousands of slots: every source stays
    within one block of its exact share."""
    w = {"a": 0.60033, "b": 0.39957, "c": 0.0001}
    rows = [(i, "x" * 9, s) for i, s in enumerate(["a"] * 6000 + ["b"] * 2000 + ["c"])]    # a block each
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.mix_slot, r.mix_source, r.doc_id) for r in mix.mix_sources(df, w, block_chars=10, range_slots=1500).select(
        "mix_slot", "mix_source", "doc_id").collect())
    assert {d for _, _, d in got} == {d for d, _, _ in rows}
    assert [t for t, _, _ in got] == list(range(len(got))) and len(got) > 5000
    taken, total = Counter(), sum(w.values())
    for t, s, _ in got:
        taken[s] += 1
        assert all(abs(taken[x] - (t + 1) * w[x] / total) < 1 for x in w), t


def test_clashing_columns_and_long_texts(spark):
    names = ["row", "id", "order", "size", "s", "bucket", "block", "offset", "part", "first", "slots", "given", "_size", "a.b", "mix_slot"]
    rows = [(i, "x" * (300_000 if i == 3 else 50), ["p", "q", None][i % 3]) for i in range(12)]
    df = spark.createDataFrame([(*r, *[f"{n}{r[0]}" for n in names]) for r in rows],
                               "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    out = mix.mixed_rows(df, block_chars=1000)
    assert out.columns == df.columns
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in df.collect()}
    rows = mix.mix_sources(df, block_chars=1000).collect()
    assert all(r["a.b"] == f"a.b{r.doc_id}" and r.size == f"size{r.doc_id}" for r in rows)
    check(rows, [(r.doc_id, r.source, len(r.text) + 1) for r in df.collect()], 1000)


def test_empty_repeated_and_wrong_weights(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix.mix_sources(empty).collect() == [] and mix.mixed_rows(empty).collect() == []
    same = spark.createDataFrame([(1, "a", "s")] * 3 + [(None, None, None)], "doc_id long, text string, source string")
    assert mix.mix_sources(same, {"s": 1, "": 1}).where("mix_epoch = 0").count() == 4
    with pytest.raises(ValueError):
        mix.mix_sources(same, {"s": 1})
