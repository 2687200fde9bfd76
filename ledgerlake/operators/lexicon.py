"""Lexicons as tables (X1, X2, D16): tokens and sentiment by a word automaton.

A lexicon is a DataFrame (word, kind, weight) of any size; kind is positive,
negative, sector or stop.  Words are found by an Aho-Corasick automaton, the
longest word at the leftmost place first, without overlaps.  Up to
``BROADCAST_WORDS`` words it is one automaton that every worker holds; beyond, the
words are cut into shards by their first character, stored in the shared folder,
and a task takes a group of texts through one shard after the other: all words
that can begin at a place are in one shard, so the longest one there is known
when the shards have been seen.  Texts are read once and never shuffled."""

from __future__ import annotations

import pickle
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .text import Lexicon, polarity

BROADCAST_WORDS = 200_000
SHARD_WORDS = 200_000
GROUP_CHARS = 4 << 20      # characters that go through a shard once it is loaded
HELD_CHARS = 1 << 18       # characters whose words are held where nothing has to be loaded
FOUND = ("tokens array<string>, sentiment_keywords array<string>, sector_keywords array<string>, "
         "positive_score int, negative_score int")


def lexicon_table(spark, lex: Lexicon) -> DataFrame:
    """The parameter lexicon as a table; a word in both sentiment lists counts
    as positive."""
    rows = [(w, "positive", int(v)) for w, v in lex.positive.items()]
    rows += [(w, "negative", int(v)) for w, v in lex.negative.items() if w not in lex.positive]
    rows += [(w, "sector", 0) for w in lex.sector_words] + [(w, "stop", 0) for w in lex.stop_words]
    return spark.createDataFrame(rows, "word string, kind string, weight int")


def _entries(words: DataFrame) -> DataFrame:
    """(word, kinds): one row per word with its kinds and weights; words that
    are only stop words are no tokens."""
    w = words.where("word IS NOT NULL AND word <> ''")
    g = w.groupBy("word").agg(F.array_sort(F.collect_set(F.struct("kind", F.coalesce("weight", F.lit(0)).alias("weight")))).alias("kinds"))
    return g.where(F.exists("kinds", lambda k: k["kind"] != "stop"))


def _automaton(rows: list[tuple[str, list]]):
    import ahocorasick
    a = ahocorasick.Automaton()
    for word, kinds in rows:
        a.add_word(word, (len(word), kinds))
    if rows:
        a.make_automaton()
    return a


def longest_at(automaton, text: str, best: dict[int, tuple[int, list]]) -> None:
    """Note the longest word at every place of ``text`` where one begins."""
    if not len(automaton):
        return
    for end, (n, kinds) in automaton.iter(text):
        at = end - n + 1
        if at not in best or best[at][0] < n:
            best[at] = (n, kinds)


def leftmost(best: dict[int, tuple[int, list]]) -> Iterator[tuple[int, int, list]]:
    """(place, length, kinds) from left to right, without overlaps."""
    free = 0
    for at in sorted(best):
        if at >= free:
            n, kinds = best[at]
            yield at, n, kinds
            free = at + n


def score(text: str, best: dict[int, tuple[int, list]], min_len: int) -> tuple[list, list, list, int, int]:
    """One row of ``FOUND``."""
    tokens, feeling, sectors, plus, minus = [], [], [], 0, 0
    for at, n, kinds in leftmost(best):
        word, of = text[at:at + n], dict(kinds)
        if n < min_len or "stop" in of:
            continue
        tokens.append(word)
        if "sector" in of:
            sectors.append(word)
        if "positive" in of or "negative" in of:
            feeling.append(word)
        if "positive" in of:
            plus += of["positive"]
        elif "negative" in of:
            minus += abs(of["negative"])
    return tokens, feeling, sectors, plus, minus


class Shards:
    """Stored automata, one in a worker's memory at a time."""

    def __init__(self, uris: list[str]):
        self.uris, self.held = uris, None

    def __iter__(self):
        order = range(len(self.uris))
        if self.held:
            order = [(self.held[0] + k) % len(self.uris) for k in order]
        for n in order:
            if not self.held or self.held[0] != n:
                from pyarrow import fs
                self.held = None
                store, path = fs.FileSystem.from_uri(self.uris[n])
                with store.open_input_stream(path) as f:
                    self.held = n, _automaton(pickle.loads(f.read()))
            yield self.held[1]


def _store_shards(entries: DataFrame, shards: int) -> list[str]:
    """Write the words of each shard as one file, by tasks."""
    spark = entries.sparkSession
    folder = re.sub(r"^file:/+", "file:///", scratch_path(spark, f"lexicon-{uuid.uuid4().hex}"))
    folder = folder if "://" in folder else f"file://{folder}"

    def write(pdf):
        from pyarrow import fs
        shard = int(pdf["shard"].iloc[0])
        store, path = fs.FileSystem.from_uri(f"{folder}/{shard}.words")
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        # A task that runs again writes the same file again.
        with store.open_output_stream(path) as f:
            f.write(pickle.dumps([(w, [(k["kind"], int(k["weight"])) for k in kinds]) for w, kinds in sorted(zip(pdf["word"], pdf["kinds"]), key=lambda x: x[0])]))
        return pd.DataFrame({"shard": [shard]})

    placed = entries.withColumn("shard", F.pmod(F.xxhash64(F.substring("word", 1, 1)), F.lit(shards)).cast("int"))
    found = sorted(r["shard"] for r in placed.groupBy("shard").applyInPandas(write, "shard int").collect())    # a row per shard
    return [f"{folder}/{n}.words" for n in found]


def analyse_with(df: DataFrame, text_col: str, words: DataFrame, min_len: int = 2, lowercase: bool = False,
                 broadcast_words: int = BROADCAST_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``df`` with the columns that :func:`text.analyse` adds, for the lexicon
    table ``words``.  Null texts have no tokens; input columns with one of the new
    names are replaced."""
    spark = df.sparkSession
    ship_package(spark)
    entries = _entries(words)
    n = entries.count()
    if n <= broadcast_words:
        rows = [(r["word"], [(k["kind"], int(k["weight"])) for k in r["kinds"]]) for r in entries.orderBy("word").collect()]
        shared = spark.sparkContext.broadcast(rows)          # at most broadcast_words words
    else:
        uris = _store_shards(entries, -(-n // shard_words))

    held: dict = {}

    @F.pandas_udf(FOUND)
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if n <= broadcast_words:
            if "a" not in held:
                held["a"] = _automaton(shared.value)
            automata, most = [held["a"]], HELD_CHARS
        else:
            automata, most = Shards(uris), GROUP_CHARS
        names = [c.split()[0] for c in FOUND.split(", ")]
        for texts in parts:
            texts, i = [t or "" for t in texts], 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size + len(texts[j]) <= most):
                    size += len(texts[j])
                    j += 1
                best: list[dict] = [{} for _ in range(i, j)]
                for a in automata:
                    for text, of in zip(texts[i:j], best):
                        longest_at(a, text, of)
                # A group's rows leave before the next ones are looked at.
                yield pd.DataFrame([score(text, of, min_len) for text, of in zip(texts[i:j], best)], columns=names)
                i = j

    names = [c.split()[0] for c in FOUND.split(", ")]
    src = F.lower(F.col(text_col)) if lowercase else F.col(text_col)
    kept = [c for c in df.columns if c not in (*names, "sentiment_score", "polarity")]
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), find(src.cast("string")).alias("found"))
    out = out.select("row.*", "found.*").withColumn("sentiment_score", F.col("positive_score") - F.col("negative_score"))
    return out.withColumn("polarity", polarity(F.col("sentiment_score")))
