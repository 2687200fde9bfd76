"""Language identification by Bayesian evidence fusion.

Four kinds of evidence multiply: the text's likelihood under a character
n-gram model of each language, the language that the markup declares, the
address's suffix, and a prior for the host.  The model is trained on a bounded
sample of labelled texts.  The other three come from the rows themselves, by
grouped sums of the text-only posteriors: how often each language declares
what, how the languages share a suffix, and the languages of a host, smoothed
towards those of its domain and these towards all rows.  A row's own share is
taken out of its host's and domain's sums, so that it is no witness for
itself.  Texts are scored in Arrow batches; sums and joins are DataFrame
operations on one row per host, domain, suffix or declaration."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package, written
from .urlfilter import registered_domain, suffix

HASH_BITS = 14
MAX_TRAIN = 8000        # labelled texts the model is fitted on
MAX_LANGUAGES = 200
EFFECTIVE = 40.0        # n-grams overlap; a text counts as at most so many
PSEUDO = 4.0            # rows that a level's parent counts for
DECLARED_PSEUDO = 1.0
SALTS = 32              # parts of a key in joins with its evidence
_PIECE = 1 << 21
_TAGS = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


def plain_text(html: bytes) -> bytes:
    """The text of a page: no tags, scripts or styles, entities resolved."""
    import html as entities
    t = _TAGS.sub(b" ", html)
    return entities.unescape(t.decode("utf-8", "replace")).encode("utf-8", "replace") if b"&" in t else t


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the letter trigrams (bytes, A-Z lowered) of all texts, and
    the first and last of each text."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    off = np.concatenate([[0], np.cumsum(lengths)])
    b = _LOWER[np.frombuffer(b"".join(texts) + b"\0\0", np.uint8)]
    x = b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - HASH_BITS)).astype(np.int64), off[:-1], np.maximum(off[1:] - 2, off[:-1])


def _pieces(texts: list[bytes]):
    i = 0
    while i < len(texts):
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j]) <= _PIECE):
            held += len(texts[j])
            j += 1
        yield i, j
        i = j


def log_likelihoods(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Mean log likelihood of a text's trigrams per language (a column of
    ``table``), times their number but at most ``EFFECTIVE``."""
    out = np.zeros((len(texts), table.shape[1]))
    for i, j in _pieces(texts):
        g, first, last = trigrams(texts[i:j])
        n = last - first
        for k in range(table.shape[1]):
            total = np.concatenate([[0.0], np.cumsum(table[g, k])])
            out[i:j, k] = (total[last] - total[first]) / np.maximum(n, 1) * np.minimum(n, EFFECTIVE)
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_train: int = MAX_TRAIN) -> tuple[list[str], np.ndarray]:
    """(languages, table[bucket, language] of log probabilities) from the
    ``max_train`` labelled texts whose ids hash lowest.  Null languages and texts
    are left out."""
    spark = docs.sparkSession
    ship_package(spark)
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL")
    h = F.xxhash64(F.col("id"), F.lit("language"))
    # The bound on the hash that lets max_train rows through, from the ids alone.
    bound = known.select(h.alias("h")).orderBy("h").limit(max_train).agg(F.max("h")).first()[0]
    if bound is None:
        return [], np.zeros((1 << HASH_BITS, 0))
    sample = known.where(h <= bound).select("lang", F.col("text").cast("binary"))

    def count(batches):
        import pyarrow as pa
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for lang, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                g, _, last = trigrams([t.as_py()])
                c = sums.setdefault(lang, np.zeros(1 << HASH_BITS, np.int64))
                c += np.bincount(g[:last[0]], minlength=1 << HASH_BITS)
            for lang, c in sums.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(c[at])],
                                                 names=["lang", "bucket", "n"])

    got = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = got.collect()     # at most languages x buckets
    langs = sorted({r["lang"] for r in rows})
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.full((1 << HASH_BITS, len(langs)), 0.5)
    where = {x: i for i, x in enumerate(langs)}
    for r in rows:
        counts[r["bucket"], where[r["lang"]]] += r["n"]
    return langs, np.log(counts / counts.sum(axis=0))


def declared_language(html: str) -> Column:
    """First subtag, in lower case, of the html element's lang; null without."""
    tag = F.regexp_extract(F.col(html), r"(?is)<html\b[^>]*\slang\s*=\s*[\"']?\s*([a-z]{1,8})", 1)
    return F.when(tag != "", F.lower(tag))


def _sum_arrays(col: str, k: int) -> Column:
    return F.array(*[F.sum(F.col(col)[i]) for i in range(k)])


def _log(x: Column) -> Column:
    return F.transform(x, lambda v: F.log(v))


def _add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _spread_join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Join with a table of one row a key, each key cut into ``SALTS`` parts: one
    host or declaration may have a third of all rows."""
    wide = table.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).join(wide, [key, "_salt"]).drop("_salt")


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """(id, lang, probability, text_lang) for every row of ``rows`` (id, body
    binary, is_markup boolean, declared, host).

    Null bodies are empty: all languages are equally likely for them.  A null
    or empty host, suffix or declaration is no evidence.  Ties go to the first
    language in alphabetical order.  Without languages all results are null."""
    spark = rows.sparkSession
    ship_package(spark)
    langs, table = model
    k = len(langs)
    if not k:
        none = F.lit(None).cast("string")
        return rows.select("id", none.alias("lang"), F.lit(None).cast("double").alias("probability"), none.alias("text_lang"))
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("array<double>")
    def likelihood(bodies: pd.Series, markup: pd.Series) -> pd.Series:
        texts = [plain_text(b) if m else b for b, m in zip((x or b"" for x in bodies), markup)]
        return pd.Series(list(log_likelihoods(texts, shared.value)))

    host = F.when(F.col("host") != "", F.col("host"))
    s = rows.select("id", F.col("declared"), host.alias("host"), registered_domain(host).alias("domain"),
                    suffix(host).alias("sfx"), likelihood(F.coalesce("body", F.lit(b"")), "is_markup").alias("ll"))
    s = written(s.withColumn("post", _softmax(F.col("ll"))), "langid-scored")

    def sums(key: str, name: str) -> DataFrame:
        return s.where(F.col(key).isNotNull()).groupBy(key).agg(
            _sum_arrays("post", k).alias(f"{name}_s"), F.count(F.lit(1)).alias(f"{name}_n"))

    everything = s.agg(_sum_arrays("post", k).alias("all_s"), F.count(F.lit(1)).alias("all_n")).first()
    n_all = everything["all_n"]
    if not n_all:
        return rows.select("id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"),
                           F.lit(None).cast("string").alias("text_lang"))
    share = F.array(*[F.lit((x + 1.0) / (n_all + k)) for x in everything["all_s"]])
    # P(declaration | language) and P(suffix | language), languages as rows' posteriors.
    def given_language(key: str, name: str) -> DataFrame:
        t = sums(key, name)
        m = t.agg(_sum_arrays(f"{name}_s", k).alias("s"), F.count(F.lit(1)).alias("n")).first()
        of = F.array(*[F.lit(float(x or 0.0) + DECLARED_PSEUDO * m["n"]) for x in m["s"]])
        return t.select(key, F.zip_with(f"{name}_s", of, lambda a, b: F.log((a + DECLARED_PSEUDO) / b)).alias(f"{name}_l"))

    def own_out(name: str, parent: Column) -> Column:
        left = F.zip_with(f"{name}_s", "post", lambda a, b: F.greatest(a - b, F.lit(0.0)))
        return F.zip_with(left, parent, lambda a, p: (a + PSEUDO * p) / (F.col(f"{name}_n") - 1 + PSEUDO))

    # Rows without a host or declaration join nothing, so that nulls, maybe
    # most rows, meet in no task.
    hosted, free = s.where("host IS NOT NULL"), s.where("host IS NULL")
    for key, evidence in (("host", sums("host", "host")), ("domain", sums("domain", "domain")), ("sfx", given_language("sfx", "sfx"))):
        hosted = _spread_join(hosted, evidence, key)
    cols = ["id", "declared", "ll"]
    hosted = hosted.withColumn("by_domain", own_out("domain", share)).select(
        *cols, _add(_log(own_out("host", F.col("by_domain"))), F.col("sfx_l")).alias("prior"))
    placed = hosted.unionByName(free.select(*cols, _log(share).alias("prior")))
    told = _spread_join(placed.where("declared IS NOT NULL"), given_language("declared", "declared"), "declared").select(
        "id", "ll", _add(F.col("prior"), F.col("declared_l")).alias("prior"))
    both = told.unionByName(placed.where("declared IS NULL").select("id", "ll", "prior"))
    names = F.array(*[F.lit(x) for x in langs])
    post = both.withColumn("post", _softmax(_add(F.col("ll"), F.col("prior"))))

    def best(x: str) -> Column:
        return F.element_at(names, F.array_position(F.col(x), F.array_max(x)).cast("int"))

    return post.select("id", best("post").alias("lang"), F.array_max("post").alias("probability"), best("ll").alias("text_lang"))


def _softmax(x: Column) -> Column:
    e = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))
