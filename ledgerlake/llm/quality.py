"""Quality rules: counted base rules, then a calibrated n-gram classifier.

Features are hashed word 1- and 2-grams and character 4-grams of the whole
text, as shares of the text's n-grams of that kind.  A logistic regression
(MLlib) is trained on a bounded sample of labelled rows; a second, one-variable
regression on held-out labelled rows turns its margin into a probability.  All
documents are then scored in Arrow batches, with numpy over the batch's bytes,
against a fixed threshold.

Words are runs without ASCII white space, texts are taken as UTF-8 bytes.

Defined cases.  Null and empty texts have no words and fail the base rules.
Repeated rows are judged one by one; in training equal rows (id and text) count
once.  Texts over ``_PIECE`` bytes are taken in parts, whose sums add up to the
whole text's: the classifier holds a part at a time, the base counts some
numbers a word.  Training reads at most ``MAX_LABELLED`` rows, however often an
id repeats.  ``quality_rules`` returns the id and its own columns, ``keep_good``
the input's; other columns do not matter, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release_memory, scratch_dir, ship_package, written

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"
KEEP_FROM = 0.5           # calibrated probability of good quality
MAX_LABELLED = 4000       # labelled rows used for training and calibration
HELD_OUT_OF = 4           # one labelled row in so many calibrates
HASH_BITS = 16            # buckets of a family; the gradient that training shuffles is 3 times this
FAMILIES = 3              # word 1-grams, word 2-grams, character 4-grams
SCALE = 30.0              # shares are small numbers; brings features to about 1
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
FIT_TASKS = 2             # the bounded sample is fitted in so many tasks: each sends a gradient a step
_PIECE = 1 << 18


# ---------------------------------------------------------------- base rules

def repeat_words(words: list[bytes], k: int = REPEAT_WINDOW) -> int:
    """Words inside ``k``-word windows that occur more than once."""
    n = len(words) - k + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    roll = h[:n].copy()
    for i in range(1, k):
        roll = roll * np.uint64(0x9E3779B97F4A7C15) + h[i:n + i]
    order = np.argsort(roll, kind="stable")
    s = roll[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    at = np.union1d(order[:-1][same], order[1:][same]).tolist()
    # Equal windows have equal hashes; the words themselves decide.
    seen: dict[tuple, list[int]] = {}
    for i in at:
        seen.setdefault(tuple(words[i:i + k]), []).append(i)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    for places in seen.values():
        if len(places) > 1:
            cover[places] += 1
            np.add.at(cover, np.array(places) + k, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def _cut_numbers(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each stretch ``start .. end`` of the bytes ``b`` (in order,
    apart); equal stretches have equal numbers."""
    import pyarrow as pa
    inside = np.zeros(len(b) + 1, dtype=np.int8)
    inside[start] = 1
    inside[end] -= 1
    data = b[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
    wide = len(b) >= 1 << 31
    ends = np.zeros(len(start) + 1, dtype=np.int64 if wide else np.int32)
    np.cumsum(end - start, out=ends[1:])
    kind = pa.large_binary() if wide else pa.binary()
    cut = pa.Array.from_buffers(kind, len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return cut.dictionary_encode().indices.to_numpy()


def _repeat_numbers(word: np.ndarray, k: int = REPEAT_WINDOW) -> int:
    """As ``repeat_words``, of numbered words."""
    n = len(word) - k + 1
    if n < 2:
        return 0
    roll = word[:n].astype(np.uint64)
    for i in range(1, k):
        roll *= np.uint64(0x9E3779B97F4A7C15)
        roll += word[i:n + i].astype(np.uint64)
    order = np.argsort(roll, kind="stable")
    roll = roll[order]
    again = np.zeros(n, dtype=bool)
    for at in range(0, n - 1, _PIECE):
        part = slice(at, min(at + _PIECE, n - 1))
        near = at + np.flatnonzero(roll[at + 1:part.stop + 1] == roll[part])
        a, b = order[near], order[near + 1]
        if not all(np.array_equal(word[a + i], word[b + i]) for i in range(k)):
            return repeat_words([b"%d" % w for w in word.tolist()], k)      # a hash stood for two windows
        again[a] = again[b] = True
    inside = np.zeros(len(word), dtype=bool)
    for i in range(k):
        inside[i:n + i] |= again
    return int(np.count_nonzero(inside))


def _long_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """``base_counts`` without an object for every word or line."""
    b = np.frombuffer(text, dtype=np.uint8)
    solid = np.concatenate([[False], ~((b == 32) | ((b >= 9) & (b <= 13))), [False]])
    width = np.int32 if len(b) < 1 << 31 else np.int64
    start = np.flatnonzero(solid[1:] & ~solid[:-1]).astype(width)
    end = np.flatnonzero(solid[:-1] & ~solid[1:]).astype(width)
    points = int(np.count_nonzero((b & 0xC0) != 0x80)) - (len(b) - int(np.count_nonzero(solid)))
    last = np.append(np.flatnonzero(b == 10), len(b)).astype(width)
    first = np.concatenate([np.zeros(1, width), last[:-1] + 1])
    worded = np.searchsorted(start, last) > np.searchsorted(start, first)
    first, last = first[worded], last[worded]
    del solid
    dup = len(first) - int(_cut_numbers(b, first, last).max(initial=-1)) - 1
    del first, last, worded
    n_words, number = len(start), _cut_numbers(b, start, end)
    del start, end
    return n_words, points, len(text) - len(text.translate(None, SYMBOLS)), dup, _repeat_numbers(number)


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    if len(text) > _PIECE:
        return _long_counts(text)
    words = text.split()
    spaces = len(text) - sum(map(len, words))
    b = np.frombuffer(text, dtype=np.uint8)
    points = int(((b & 0xC0) != 0x80).sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), points - spaces, len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words))


# ---------------------------------------------------------------- features

_BASE = 0x9E3779B97F4A7C15                # odd: has an inverse modulo 2^64
_BACK = pow(_BASE, -1, 1 << 64)
_OF_BYTE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x94D049BB133111EB)) ^ np.uint64(0xD6E8FEB86659FD93)


def _powers(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _bucket(x: np.ndarray, family: int) -> np.ndarray:
    x = (x + np.uint64(family + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - HASH_BITS)).astype(np.int64) + (family << HASH_BITS)


def ngrams(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per family (buckets, first, last): the n-grams of all texts in order,
    and for text ``d`` those from ``first[d]`` to before ``last[d]``."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    off = np.concatenate([[0], np.cumsum(lengths)])
    b = np.frombuffer(b"".join(texts) + b"\0" * 8, dtype=np.uint8)
    n = int(off[-1])
    v = b.astype(np.uint64)
    v = v[:-1] << np.uint64(8) | v[1:]
    v4 = v[:-2] << np.uint64(16) | v[2:]
    chars = _bucket(v4[:n], 2)
    char_last = np.maximum(off[1:] - 3, off[:-1])
    solid = ~((b[:n] == 32) | ((b[:n] >= 9) & (b[:n] <= 13)))
    first_of_text = np.zeros(n + 1, dtype=bool)
    first_of_text[off] = True
    before = np.concatenate([[False], solid[:-1]]) & ~first_of_text[:n]
    start = np.flatnonzero(solid & ~before)
    after = np.concatenate([solid[1:], [False]]) & ~first_of_text[1:n + 1]
    size = np.flatnonzero(solid & ~after) + 1 - start
    # A word is the polynomial hash of all its bytes: sums up to its ends, their
    # difference shifted back to the word's own start.
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_OF_BYTE[b[:n]] * _powers(_BASE, n), out=sums[1:])
    word = (sums[start + size] - sums[start]) * _powers(_BACK, n)[start] + size.astype(np.uint64)
    word ^= word >> np.uint64(32)
    w_first = np.searchsorted(start, off[:-1])
    w_last = np.searchsorted(start, off[1:])
    two = word[:-1] * np.uint64(0xD6E8FEB86659FD93) + word[1:] if len(word) else word
    return [(_bucket(word, 0), w_first, w_last), (_bucket(two, 1), w_first, np.maximum(w_last - 1, w_first)),
            (chars, off[:-1], char_last)]


def long_ngrams(text: bytes, piece: int | None = None):
    """The buckets of the families of one text, part by part.  A word that goes
    on into the next part travels as the hash and length of what was read."""
    piece = piece or _PIECE
    mask = (1 << 64) - 1
    held, held_len, before = 0, 0, None
    for at in range(0, len(text), piece):
        b = np.frombuffer(text[at:at + piece + 3], dtype=np.uint8)
        n = min(piece, len(text) - at)
        v = b.astype(np.uint64)
        v = v[:-1] << np.uint64(8) | v[1:]
        chars = _bucket((v[:-2] << np.uint64(16) | v[2:])[:n], 2)
        solid = np.concatenate([[False], ~((b[:n] == 32) | ((b[:n] >= 9) & (b[:n] <= 13))), [False]])
        start, end = np.flatnonzero(solid[1:] & ~solid[:-1]), np.flatnonzero(solid[:-1] & ~solid[1:])
        size = (end - start).astype(np.uint64)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_OF_BYTE[b[:n]] * _powers(_BASE, n), out=sums[1:])
        word = (sums[end] - sums[start]) * _powers(_BACK, n)[start]
        if held_len and not (len(start) and start[0] == 0):     # the word ended with the part before
            word, size = np.append(np.uint64(held), word), np.append(np.uint64(held_len), size)
        elif held_len:
            word[0] = (held + int(word[0]) * pow(_BASE, held_len, 1 << 64)) & mask
            size[0] += np.uint64(held_len)
        held, held_len = 0, 0
        if len(end) and end[-1] == n and at + n < len(text):
            held, held_len = int(word[-1]), int(size[-1])
            word, size = word[:-1], size[:-1]
        word = word + size
        word ^= word >> np.uint64(32)
        chain = word if before is None else np.append(before, word)
        two = chain[:-1] * np.uint64(0xD6E8FEB86659FD93) + chain[1:]
        before = chain[-1:] if len(chain) else None
        yield [_bucket(word, 0), _bucket(two, 1), chars]


def margins(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    """The classifier's margin of each text."""
    out = np.full(len(texts), bias)
    for d, text in enumerate(texts):
        if len(text) > _PIECE:
            total, count = np.zeros(FAMILIES), np.zeros(FAMILIES)
            for families in long_ngrams(text):
                total += [weights[b].sum() for b in families]
                count += [len(b) for b in families]
            out[d] += (SCALE * total / np.maximum(count, 1)).sum()
    short = [t if len(t) <= _PIECE else b"" for t in texts]
    for buckets, first, last in ngrams(short):
        total = np.concatenate([[0.0], np.cumsum(weights[buckets])])
        out += SCALE * (total[last] - total[first]) / np.maximum(last - first, 1)
    return out


def sparse_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    if len(text) > _PIECE:
        found = np.zeros((FAMILIES, FAMILIES << HASH_BITS))
        for families in long_ngrams(text):
            for f, b in enumerate(families):
                found[f] += np.bincount(b, minlength=FAMILIES << HASH_BITS)
        share = (SCALE * found / np.maximum(found.sum(axis=1, keepdims=True), 1)).sum(axis=0)
        return np.flatnonzero(share), share[share > 0]
    idx, val = [], []
    for buckets, _, last in ngrams([text]):
        b, c = np.unique(buckets[:last[0]], return_counts=True)
        idx.append(b)
        val.append(SCALE * c / max(1, int(last[0])))
    return np.concatenate(idx), np.concatenate(val)


def pieces(texts: list[bytes]):
    """Runs of texts of about ``_PIECE`` bytes, or of one longer text."""
    i = 0
    while i < len(texts):
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j]) <= _PIECE):
            held += len(texts[j])
            j += 1
        yield i, j
        i = j


# ---------------------------------------------------------------- model

@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> QualityModel | None:
    """Fit on the ``max_labelled`` labelled rows whose id hashes lowest (then
    those of the lowest text hash).

    Null labels, ids or texts are left out; an id with several labels counts
    with its smallest, equal rows count once.  None if the training part lacks
    one of the classes."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.linalg import VectorUDT
    spark = docs.sparkSession
    ship_package(spark)
    h = F.xxhash64(F.col("id"), F.lit("quality"))
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
             .where("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.min("label").alias("label")))
    bodies = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(
        F.col("text").isNotNull() & F.col("id").isNotNull())
    # At most max_labelled ids, whatever the size of the tables; an id can have many rows, so these are bounded next.
    lowest = known.join(bodies.select("id").distinct(), "id", "left_semi").orderBy(h, "id").limit(max_labelled)
    mine = written(bodies.join(F.broadcast(lowest), "id").withColumn("body", F.xxhash64("text")), "quality-labelled")
    chosen = mine.select("id", "body").distinct().orderBy(h, "id", "body").limit(max_labelled)
    rows = (mine.join(F.broadcast(chosen), ["id", "body"]).groupBy("id", "body", "label").agg(F.first("text").alias("text"))
            .withColumn("held", F.pmod(h, F.lit(HELD_OUT_OF)) == 0))
    dims = FAMILIES << HASH_BITS
    # A sparse vector as Spark stores it: made once here, read back as a vector.
    fields = ["type", "size", "indices", "values"]

    def features(batches):
        import pyarrow as pa
        for batch in batches:
            got = [sparse_features(t.as_py()) for t in batch.column(0)]
            vector = pa.StructArray.from_arrays(
                [pa.array([0] * len(got), pa.int8()), pa.array([dims] * len(got), pa.int32()),
                 pa.array([i for i, _ in got], pa.list_(pa.int32())), pa.array([v for _, v in got], pa.list_(pa.float64()))],
                names=fields)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), vector], names=["label", "held", "features"])

    stored = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"
    path = scratch_dir(spark, "quality-sample")
    rows.select(F.col("text").cast("binary"), "label", "held").mapInArrow(
        features, f"label double, held boolean, features {stored}").write.parquet(path)
    as_vector = T.StructType().add("label", "double").add("held", "boolean").add("features", VectorUDT())
    sample = spark.read.schema(as_vector).parquet(path).coalesce(FIT_TASKS)
    fit = sample.where("not held")
    if fit.select("label").distinct().limit(2).count() < 2:
        return None
    lr = LogisticRegression(maxIter=40, regParam=1e-4, standardization=False, aggregationDepth=2).fit(fit)
    weights, bias = lr.coefficients.toArray(), float(lr.intercept)
    slope, shift = 1.0, 0.0
    margin = written(lr.transform(sample.where("held")).select(
        "label", array_to_vector(F.slice(vector_to_array("rawPrediction"), 2, 1)).alias("features")).coalesce(1), "quality-margins")
    if margin.select("label").distinct().limit(2).count() == 2:
        platt = LogisticRegression(maxIter=50, regParam=1e-3).fit(margin)
        slope, shift = float(platt.coefficients[0]), float(platt.intercept)
    return QualityModel(weights, bias, slope, shift)


def score(docs: DataFrame, model: QualityModel | None, text_col: str = "text", out: str = "quality_rules") -> DataFrame:
    """``docs`` with a struct column ``out``: the base counts, base_failed,
    probability (null without a model) and kept.

    Null texts have no words and fail the base rules; without a model the base
    rules alone decide."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = None if model is None else spark.sparkContext.broadcast(model)

    def judge(texts: pd.Series) -> pd.DataFrame:
        bodies = [t or b"" for t in texts]
        df = pd.DataFrame([base_counts(t) for t in bodies], columns=[c.split()[0] for c in BASE.split(", ")], dtype="int64")
        failed = (df["n_words"] < MIN_WORDS) | (100 * df["n_repeat_words"] > MAX_REPEAT_PERCENT * df["n_words"])
        df["base_failed"] = failed
        if shared is None:
            df["probability"], df["kept"] = None, ~failed
            return df
        m = shared.value
        at = np.concatenate([margins(bodies[i:j], m.weights, m.bias) for i, j in pieces(bodies)] or [np.zeros(0)])
        p = 1 / (1 + np.exp(-np.clip(m.slope * at + m.shift, -500, 500)))
        df["probability"], df["kept"] = p, ~failed & (p >= KEEP_FROM)
        return df

    @F.pandas_udf(BASE + ", base_failed boolean, probability double, kept boolean")
    def rules(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield judge(texts)
            release_memory()

    return docs.withColumn(out, rules(F.col(text_col).cast("binary")))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base counts, base_failed, probability, kept) of every document."""
    model = train(docs, labels, id_col, text_col)
    s = score(docs.select(F.col(id_col), F.col(text_col)), model, text_col, "_q")
    return s.select(id_col, "_q.*")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, unchanged."""
    out = "_quality_rules"
    while out in docs.columns:
        out += "_"
    judged = score(docs, train(docs, labels, id_col, text_col), text_col, out)
    return judged.where(F.col(f"{out}.kept")).drop(out)
