"""Token output: exact round trip against the tokenizers library itself."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF001
from ledgerlake.llm import queries, tokens
from ledgerlake.llm.common import scratch_dir


def brute(rows, end=2):
    tok = Tokenizer.from_file(queries.tokenizer_path())
    out, start = [], 0
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_is_exact(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect())
    got = sorted(map(tuple, queries.QUERIES["op5_token_output"](spark, SF001).collect()))
    assert got == brute(docs)


ODD = ["", None, "a", "<|endoftext|>x <|startoftext|> <|EndOfText|>", "don't we'll I'M x's 's", "e\u0301 E\u0301 \u0301x",
       "ΑΣ ΑΣ. İstanbul ǅ", "a\u00a0b\u2003c\u3000d \x85 \x1c\x1d x", "123 4５ ٣", "日本語 テキスト", "😀 a😀b \u200d x\u0000y", "x" * 5000,
       "\u1100\u1161 가 \u1100 \u1161"]


def test_odd_texts_nulls_and_small_shards(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(500, " ".join(f"w{i * i % 9973}" for i in range(60_000)))]
    df = spark.createDataFrame([(d, t, 7, "x") for d, t in rows], "doc_id long, text string, start int, id string").repartition(5)
    folder = scratch_dir(spark, "t")
    m = tokens.write_tokens(df, queries.tokenizer_path(), folder, shard_tokens=50)
    assert m.count() >= 3
    got = sorted(map(tuple, tokens.read_documents(m, folder).collect()))
    assert got == brute(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "first"), (3, "same"), (3, "same"), (3, "other text"), (-1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = tokens.tokenise(df, queries.tokenizer_path()).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == [(False, 0), (True, -1), (True, 3), (True, 3), (True, 3)]
    assert min(r.start for r in got if r.doc_id == 3) > max(r.start for r in got if r.doc_id == -1) > 0
    assert sorted(r.ids_crc32 for r in got) == sorted(x[3] for x in brute(rows))
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_empty_table(spark):
    assert tokens.tokenise(spark.createDataFrame([], "doc_id long, text string"), queries.tokenizer_path()).collect() == []


def test_order_columns(spark):
    df = spark.createDataFrame([(i, f"t{i}", -i) for i in range(50)], "doc_id long, text string, slot long")
    got = tokens.tokenise(df, queries.tokenizer_path(), order=[F.col("slot")]).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == list(range(49, -1, -1))


@pytest.mark.parametrize("top", [10, 255, 256, 49407, 1 << 20, (1 << 32) - 1])
def test_codes_are_directly_addressable(top):
    rng = random.Random(top)
    ids = np.array([rng.randint(0, top) for _ in range(3000)] + [0, top], dtype="<u4")
    s = tokens.Shard(tokens.encode_shard([5, None], np.array([0, 1000, len(ids)]), ids))
    assert (s.slice(0, len(ids)) == ids).all()
    for i in [0, 1, 511, 512, 513, len(ids) - 1, *rng.sample(range(len(ids)), 200)]:
        assert s.token(i) == ids[i]
    for _ in range(100):
        i, j = sorted(rng.sample(range(len(ids) + 1), 2))
        assert (s.slice(i, j) == ids[i:j]).all()
    assert s.doc_ids() == [5, None] and (s.document(1) == ids[1000:]).all()
    with pytest.raises(IndexError):
        s.token(len(ids))


def test_words_beyond_the_cache_are_encoded_too():
    tok = Tokenizer.from_file(queries.tokenizer_path())
    w = tokens.WordEncoder(tok, 1)
    t = "alpha beta gamma alpha beta"
    assert w.text(t.encode()) == np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert len(w) == 1
    assert tokens.splits_on_space(queries.tokenizer_path())


def test_plain_words_go_to_the_model_as_the_library_would_send_them():
    tok = Tokenizer.from_file(queries.tokenizer_path())
    assert tokens.cuts_runs(queries.tokenizer_path())
    rng = random.Random(5)
    marks = [chr(c) for c in [*range(33, 127), *range(0xC0, 0x100)]] + list("abcdefghijklmnop") * 6
    words = ["".join(rng.choice(marks) for _ in range(rng.randint(1, 14))) for _ in range(20_000)]
    words += [chr(c) for c in range(33, 0x180)] + [f"a{chr(c)}b1" for c in range(33, 0x180)] + ["x" * 3000, "it's", "<|endoftext|>", "a<|b|>"]
    w = tokens.WordEncoder(tok, 100, True)
    for x in words:
        if not x.split() or x.split() != [x]:
            continue
        assert w[x.encode()] == w.whole(x.encode()), x
