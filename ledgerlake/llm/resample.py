"""Importance resampling of documents towards a target distribution.

Texts become hashed word n-grams: Arrow kernels lower-case (``ascii_lower``),
cut (``split_pattern_regex``), flatten (``list_flatten``) and number
(``dictionary_encode``) the words of a slice of rows; an n-gram is a pair of the
(n-1)-gram's number and the next word's, numbered by ``dictionary_encode``
again, so a checksum is taken once per distinct n-gram and slice.  A first pass
over both corpora counts the buckets (one row per task and bucket is shuffled);
log ratios of the smoothed bucket shares are the gains.  A second pass takes the
gains through the numbers and sums them per document (a segment reduction).
Documents are drawn without replacement by the largest weight plus Gumbel noise,
the noise being a hash of the id, so that a rerun draws the same rows.

Defined cases.  Null and empty texts have no words: no features, weight 0.  A
null id is hashed as the empty string and sorts after all others.  Repeated rows
are counted and drawn like any other; rows that tie in score and id rank in any
order.  Without documents the result is empty, without a target its counts are
0.  Long texts are cut between words, so a task holds a few megabytes of text
(plus one word) at a time.  Only the id and the text are read: other columns,
whatever their names, do not matter."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import dense_index
from .common import ship_package, written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"    # after lower-casing: all ASCII but digits and letters
BUCKETS = 10_000
MAX_N = 2
PERCENT = 10
MIN_WORDS = 20
SEED = "2024"
PIECE = 1 << 20           # characters of text that a task holds as words at a time
_GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")     # the same before lower-casing


# ---------------------------------------------------------------- n-grams

def pieces(texts: pa.Array, max_n: int = 1) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """(rows, texts, lead): runs of rows, texts longer than ``PIECE`` cut between
    words.  A later part starts with the last ``max_n - 1`` words before it;
    ``lead`` counts them."""
    rows, parts, lead, held = [], [], [], 0

    def take():
        return np.array(rows, dtype=np.int64), pa.array(parts, pa.string()), np.array(lead, dtype=np.int64)

    for row, text in enumerate(texts):
        text = text.as_py() or ""
        at, before = 0, []
        while True:
            gap = _GAP.search(text, at + PIECE) if len(text) - at > PIECE else None
            end = gap.start() if gap else len(text)
            if rows and held + end - at > PIECE:
                yield take()
                rows, parts, lead, held = [], [], [], 0
            rows.append(row)
            parts.append(" ".join([*before, text[at:end]]))
            lead.append(len(before))
            held += end - at
            if gap is None:
                break
            if max_n > 1:
                before = [w for w in _GAP.split(parts[-1]) if w][1 - max_n:]
            at = gap.end()
    if rows:
        yield take()


def grams(texts: pa.Array, lead: np.ndarray, max_n: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For n = 1, 2, ...: (n, the text of each n-gram, its bucket), in order.
    An n-gram counts where its last word is not one of the ``lead`` words."""
    words = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
    flat, parent = pc.list_flatten(words), pc.list_parent_indices(words)
    solid = pc.greater(pc.binary_length(flat), 0)
    flat, parent = flat.filter(solid), parent.filter(solid).to_numpy()
    coded = flat.dictionary_encode()
    word = coded.indices.to_numpy().astype(np.int64)
    names = [w.encode() for w in coded.dictionary.to_pylist()]
    place = np.arange(len(word)) - np.searchsorted(parent, parent)      # of a word in its text
    new = place >= lead[parent] if len(word) else np.zeros(0, dtype=bool)
    gram, last = word, np.arange(len(word))     # number of each n-gram, place of its last word
    crc = np.fromiter(map(zlib.crc32, names), dtype=np.int64, count=len(names))
    for n in range(1, max_n + 1):
        if n > 1:
            # The n-gram that ends at a word is the (n-1)-gram before it and the word.
            follows = np.flatnonzero(np.append(place, 0)[last + 1] >= n - 1)
            pair = gram[follows] * max(len(names), 1) + word[last[follows] + 1]
            coded = pa.array(pair).dictionary_encode()
            shorter = crc
            crc = np.fromiter((zlib.crc32(b" " + names[k % len(names)], int(shorter[k // len(names)]))
                               for k in coded.dictionary.to_pylist()), dtype=np.int64, count=len(coded.dictionary))
            gram, last = coded.indices.to_numpy().astype(np.int64), last[follows] + 1
        keep = new[last]
        yield n, parent[last[keep]], (crc % buckets)[gram[keep]]


def bucket_counts(df: DataFrame, text_col: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, features): how many n-grams of the texts fall in each bucket."""
    ship_package(df.sparkSession)

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts, lead in pieces(batch.column(0), max_n):
                for _, _, bucket in grams(texts, lead, max_n, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "features"])

    part = df.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket long, features long")
    return part.groupBy("bucket").agg(F.sum("features").alias("features"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """1000 times the log ratio of a bucket's add-one share of the target to
    that of the source, floored.  At most ``buckets`` rows of each side come to
    the driver."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, into in ((source, s), (target, t)):
        for r in counts.collect():
            into[r.bucket] = r.features
    s_all, t_all = s.sum(), t.sum()
    return np.array([math.floor(1000 * math.log((b + 1) * (s_all + buckets) / ((a + 1) * (t_all + buckets))))
                     for a, b in zip(s.tolist(), t.tolist())], dtype=np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          max_n: int = MAX_N) -> DataFrame:
    """(id, n_words, n_features, weight) of every row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(gains)     # one number a bucket

    def score(batches):
        gain = shared.value
        for batch in batches:
            out = np.zeros((3, batch.num_rows), dtype=np.int64)
            for rows, texts, lead in pieces(batch.column(1), max_n):
                for n, text, bucket in grams(texts, lead, max_n, len(gain)):
                    found = np.bincount(text, minlength=len(rows))
                    ends = np.cumsum(found)
                    sums = np.concatenate([[0], np.cumsum(gain.take(bucket))])
                    np.add.at(out[2], rows, sums[ends] - sums[ends - found])
                    np.add.at(out[1], rows, found)
                    if n == 1:
                        np.add.at(out[0], rows, found)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)],
                                             names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score, f"id {kind}, n_words long, n_features long, weight long")


# ---------------------------------------------------------------- drawing

def noise(id_col, seed: str = SEED):
    """1000 times a Gumbel variate, floored, from the id's hash."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    u = (h.cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row: rank 1, 2,
    ... for the ``percent`` of the rows with ``min_words`` words that have the
    highest scores, null for the others."""
    gains = bucket_gains(bucket_counts(docs, text_col, max_n, buckets),
                         bucket_counts(target, target_text_col, max_n, buckets), buckets)
    scored = written(weigh(docs, gains, id_col, text_col, max_n)
                     .withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "resample-scores")
    able = scored.where(F.col("n_words") >= min_words)
    # A score below which none is drawn, so that only about the drawn rows are sorted.
    n, low = able.agg(F.count(F.lit(1)), F.percentile_approx("score", max(0.0, 0.99 - percent / 100), 1000)).first()
    drawn = percent * n // 100
    top = F.col("n_words") >= min_words
    if n and able.where(F.col("score") >= low).count() >= drawn:
        top &= F.col("score") >= low
    sorted_rows = dense_index(scored.where(top), [F.desc("score"), F.asc_nulls_last("id")], "_at")
    ranked = sorted_rows.withColumn("rank", F.when(F.col("_at") < drawn, F.col("_at") + 1)).drop("_at")
    rest = scored.where(~top).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is drawn, unchanged (rows that share an id
    are kept together)."""
    chosen = resample(docs, target, id_col, **options).where("rank IS NOT NULL").select(F.col("id").alias(id_col))
    return docs.join(chosen.distinct(), docs[id_col].eqNullSafe(chosen[id_col]), "left_semi")
