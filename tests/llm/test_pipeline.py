"""The corpus pipeline, stage by stage, against brute-force renderings."""

import os
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as cp
from conftest import SF001
from ledgerlake.llm import decontam, quality, queries
from ledgerlake.llm.common import scratch_dir
from test_decontam import brute as brute_leaks
from test_simhash import naive_groups


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    tables = [docs]
    for name, stage in cp.STAGES:
        path = scratch_dir(spark, name)
        stage(spark, tables[-1], SF001).write.parquet(path)
        tables.append(spark.read.parquet(path))
        if name != "token_output":
            assert tables[-1].columns == docs.columns
    rows = [[tuple(r) for r in t.collect()] for t in tables[:-1]]
    text = {r[0]: r[1] for r in rows[0]}
    # 1 quality: unchanged rows; all that fail the base rules are gone.
    assert set(rows[1]) < set(rows[0])
    kept = {r[0] for r in rows[1]}
    for d, t in text.items():
        n, _, _, _, rep = quality.base_counts(t.encode())
        if n < quality.MIN_WORDS or 100 * rep > quality.MAX_REPEAT_PERCENT * n:
            assert d not in kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1 and quality.base_counts(text[d].encode())[0] >= 20
            and quality.base_counts(text[d].encode())[4] == 0]
    assert np.mean([d in kept for d in good]) > 0.97
    # 2 near copies: the smallest id of each group.
    groups = naive_groups([(r[0], r[1]) for r in rows[1]])
    assert sorted(rows[2]) == sorted(r for r in rows[1] if r[0] in {c for _, _, c in groups})
    # 3 decontamination.
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    norm = {r[0]: "".join(map(chr, decontam.normalise(r[1]))) for r in rows[2]}
    exact = {d for d, t in norm.items() if any("".join(map(chr, decontam.normalise(x))) in t for _, x in items)}
    gone = {r[0] for r in rows[2]} - {r[0] for r in rows[3]}
    assert exact <= gone and set(rows[3]) <= set(rows[2])
    assert all(brute_leaks([(d, text[d])], items) for d in gone - exact)
    # 4 mixing: every row at least once, nothing else.
    assert set(rows[4]) == set(rows[3]) and len(rows[4]) >= len(rows[3])
    # 5 tokens, in the stored order.
    tok = Tokenizer.from_file(queries.tokenizer_path())
    out = sorted((r.start, r.n_tokens, r.ids_crc32, r.doc_id) for r in tables[-1].collect())
    at = 0
    for (start, n, crc, d), row in zip(out, rows[4], strict=True):
        ids = tok.encode(row[1], add_special_tokens=False).ids + [2]
        assert (start, n, crc, d) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), row[0])
        at += n


def test_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    empty = spark.createDataFrame([], schema)
    odd = spark.createDataFrame([(None, None, None, None, None, None), (1, "", "en", "s", 0, "x"), (1, "", "en", "s", 0, "x")], schema)
    for docs in (empty, odd):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF001)
            assert name == "token_output" or out.columns == docs.columns
            out.collect()


def test_run_leaves_only_its_result(spark):
    from ledgerlake.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).replace("file:", "", 1)
    before = set(os.listdir(base))
    rows = cp.run(spark, SF001).collect()
    assert rows and {r.n_tokens > 0 for r in rows} == {True}
    left = sorted(p.split("-")[0] for p in set(os.listdir(base)) - before if not p.startswith("rdd"))
    assert left == ["pipeline", "tokens"], left


def test_registered():
    import __spark_entry__ as e
    assert e.queries()["pipeline"].__doc__ == cp.run.__doc__
    names = {n.split("_")[0] for n in e.queries() if n.startswith("op")}
    assert {f"op{i}" for i in range(1, 14)} <= names
    assert set(e.oracle_sql()) <= set(e.queries())
