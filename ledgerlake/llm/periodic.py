"""Periodic runs of words: stretches that repeat with a short period.

A run is a maximal stretch of words with smallest period ``q`` and at least
``max(min_length, min_exponent * q)`` words.  Seed and extend on diagonals:
within a run the words at ``i`` and ``i + q`` agree over ``length - q`` words, so
the k-grams at both places are equal for any ``k`` up to that overlap.  Lags are
taken in classes ``lo .. k`` where ``k`` is the smallest overlap that a run of a
lag from ``lo`` on guarantees.  As ``k >= q``, a k-gram of a run with smallest
period ``q`` recurs in it after exactly ``q`` words, never earlier: neighbouring
occurrences of a k-gram in a document are all the pairs a class needs, at most
one a word, and a lag that is a multiple of the smallest period never appears.
Each pair seeds its lag's diagonal and is extended both ways; a per-lag table of
the furthest covered place drops the seeds inside a stretch already extended.

k-grams are exact: words are numbered by ``dictionary_encode``, longer grams by
pairs of shorter ones (doubling), and a place whose shorter gram does not recur
in its document is left out of the longer ones.  Documents are independent: no
shuffle; texts go through in slices of a few megabytes, several short ones at a
time.

Defined cases.  Null, empty and white texts have no words and no runs.  Repeated
rows and null ids are judged row by row.  A long text is worked on whole: about
60 bytes a byte of its text at the peak.  ``find_runs`` returns the columns it
names, other columns do not matter; ``drop_repeats`` keeps all columns of its
input and replaces the text."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package

MIN_LENGTH = 6
MIN_EXPONENT = 4
PIECE = 1 << 21          # bytes of text that are searched together


# ---------------------------------------------------------------- words

def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of each word, first word of each text and the end, word starts,
    word ends): words of all texts in order, places in the joined bytes."""
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    b = np.frombuffer(b"".join(texts), dtype=np.uint8)
    n = len(b)
    solid = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    start = np.flatnonzero(solid & (edge[:n] | ~np.concatenate([[False], solid[:-1]])))
    end = np.flatnonzero(solid & (edge[1:] | ~np.concatenate([solid[1:], [False]]))) + 1
    ends = np.concatenate([[0], np.cumsum(end - start)])
    kind, width = (pa.large_binary(), np.int64) if ends[-1] >= 1 << 31 else (pa.binary(), np.int32)
    words = pa.Array.from_buffers(kind, len(start), [None, pa.py_buffer(ends.astype(width).tobytes()),
                                                     pa.py_buffer(b[solid].tobytes())])
    number = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    return number, np.searchsorted(start, off), start, end


# ---------------------------------------------------------------- seeds

def lag_classes(longest: int, min_length: int, min_exponent: float) -> Iterator[tuple[int, int]]:
    """(lo, k): lags lo .. k are found by k-grams; ends when a run of lag lo is
    longer than ``longest`` words."""
    def shortest(q):
        return max(min_length, math.ceil(min_exponent * q))
    lo = 1
    while shortest(lo) <= longest:
        # min_length - q falls, (min_exponent - 1) * q rises: the least is near where they meet.
        meet = max(lo, math.floor(min_length / min_exponent))
        k = min(shortest(q) - q for q in {lo, meet, meet + 1})
        yield lo, k
        lo = k + 1


def _numbered(key: np.ndarray) -> np.ndarray:
    return pa.array(key).dictionary_encode().indices.to_numpy().astype(np.int64)


def _recurring(at: np.ndarray, gram: np.ndarray, doc: np.ndarray):
    """Places sorted by gram, and which neighbours there are the same gram of
    the same document."""
    order = np.argsort(gram, kind="stable")
    p, g = at[order], gram[order]
    return p, (g[1:] == g[:-1]) & (doc[p[1:]] == doc[p[:-1]])


class Grams:
    """Exact numbers of the k-grams at the places where they may recur in their
    document, for growing k."""

    def __init__(self, word: np.ndarray, doc: np.ndarray):
        self.doc, self.size, self.half = doc, 1, None
        self.at, self.gram = np.arange(len(word)), word
        self._prune()

    def _prune(self):
        p, same = _recurring(self.at, self.gram, self.doc)
        keep = np.zeros(len(self.doc), dtype=bool)
        keep[p[1:][same]] = True
        keep[p[:-1][same]] = True
        hold = keep[self.at]
        self.at, self.gram = self.at[hold], self.gram[hold]

    def longer(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, numbers) of grams of ``k`` words, from two overlapping ones
        of ``size`` words (size <= k <= 2 * size)."""
        if k == self.size or not len(self.at):
            return self.at, self.gram
        step = k - self.size
        there = np.minimum(np.searchsorted(self.at, self.at + step), len(self.at) - 1)
        both = (self.at[there] == self.at + step) & (self.doc[self.at[there]] == self.doc[self.at])
        return self.at[both], _numbered(self.gram[both] * (int(self.gram.max()) + 1) + self.gram[there[both]])

    def pairs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, lag) of every two neighbouring occurrences of a k-gram."""
        while 2 * self.size <= k and len(self.at):
            self.at, self.gram = self.longer(2 * self.size)
            self.size *= 2
            self._prune()
        p, same = _recurring(*self.longer(k), self.doc)
        return p[:-1][same], (p[1:] - p[:-1])[same]


# ---------------------------------------------------------------- extension

def _agreeing(word: np.ndarray, i: int, lag: int, end: int, step: int) -> int:
    """How many places from ``i`` on (``step`` 1: upwards below ``end``; -1:
    downwards to ``end``) hold the word that is ``lag`` places further."""
    done, width = 0, 32
    left = (end - i) if step > 0 else (i - end + 1)
    while left > 0:
        n = min(width, left)
        at = i + done if step > 0 else i - done - n + 1
        differ = np.flatnonzero(word[at:at + n] != word[at + lag:at + lag + n])
        if len(differ):
            return done + int(differ[0] if step > 0 else n - 1 - differ[-1])
        done, left, width = done + n, left - n, width * 2
    return done


def word_runs(word: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: float = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """Per text the runs (start, length, period) by start and period; text ``d``
    has the words ``first[d]`` to before ``first[d + 1]``."""
    if min_exponent <= 2:
        raise ValueError("min_exponent must be over 2")
    sizes = np.diff(first)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    if not len(word):
        return runs
    doc = np.repeat(np.arange(len(sizes)), sizes)
    grams = Grams(word, doc)
    covered: dict[tuple[int, int], int] = {}      # (text, lag) -> end of the furthest stretch extended
    for lo, k in lag_classes(int(sizes.max()), min_length, min_exponent):
        at, lag = grams.pairs(k)
        fits = (lag >= lo) & (lag <= k)
        at, lag = at[fits], lag[fits]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        # A seed next to another of its lag lies in the same stretch.
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])
        fresh[1:] |= doc[at[1:]] != doc[at[:-1]]
        for i, q in zip(at[fresh].tolist(), lag[fresh].tolist()):
            d = int(doc[i])
            if i < covered.get((d, q), -1):
                continue
            begin, end = int(first[d]), int(first[d + 1])
            s = i - _agreeing(word, i - 1, q, begin, -1)
            e = i + _agreeing(word, i, q, end - q, 1)
            covered[d, q] = e
            if e - s + q >= max(min_length, min_exponent * q):
                runs[d].append((s - begin, e - s + q, q))
    for r in runs:
        r.sort(key=lambda x: (x[0], x[2]))
    return runs


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words are in no run after the run's first period."""
    step = np.zeros(n + 1, dtype=np.int64)
    for s, length, q in runs:
        step[s + q] += 1
        step[s + length] -= 1
    return np.cumsum(step[:-1]) == 0


def search(texts: list[bytes], min_length: int, min_exponent: float) -> Iterator[tuple[int, list, bytes]]:
    """Per text: number of words, runs, and the kept words joined by spaces."""
    i = 0
    while i < len(texts):
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j]) <= PIECE):
            held += len(texts[j])
            j += 1
        part = texts[i:j]
        i = j
        word, first, start, end = split_words(part)
        joined = b"".join(part)
        for d, runs in enumerate(word_runs(word, first, min_length, min_exponent)):
            a, b = int(first[d]), int(first[d + 1])
            keep = a + np.flatnonzero(kept_words(b - a, runs)) if runs else np.arange(a, b)
            yield b - a, runs, b" ".join([joined[x:y] for x, y in zip(start[keep].tolist(), end[keep].tolist())])


# ---------------------------------------------------------------- operator

def _searched(df: DataFrame, text_col: str, min_length: int, min_exponent: float) -> DataFrame:
    """``df`` (whose columns have plain names) with n_words, runs, collapsed."""
    ship_package(df.sparkSession)
    at, rest = df.columns.index(text_col), [c for c in df.columns if c != text_col]

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()]
            n_words, runs, kept = [], [], []
            for n, found, text in search(texts, min_length, min_exponent):
                n_words.append(n)
                runs.append(found)
                kept.append(text)
            flat = np.array([x for r in runs for x in r], dtype=np.int64).reshape(-1, 3)
            fields = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [c for k, c in enumerate(batch.columns) if k != at]
                + [pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(offsets, fields),
                   pa.array(kept, pa.binary()).cast(pa.string())],
                names=rest + ["n_words", "runs", "collapsed"])

    out = T.StructType([f for f in df.schema.fields if f.name != text_col])
    run_type = T.StructType().add("start", "long").add("length", "long").add("period", "long")
    return df.mapInArrow(run, out.add("n_words", "long").add("runs", T.ArrayType(run_type)).add("collapsed", "string"))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
              min_exponent: float = MIN_EXPONENT) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: the runs by start and
    period, and the words that are in no run after its first period, joined by
    one space."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return _searched(rows, "text", min_length, min_exponent)


def drop_repeats(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH,
                 min_exponent: float = MIN_EXPONENT) -> DataFrame:
    """``docs`` with every text that holds a run replaced by its kept words;
    other texts stay as they are."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).cast("string").alias("text"))
    found = _searched(rows, "text", min_length, min_exponent)
    return found.select(*[F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col(f"row.`{c}`")).alias(c)
                          if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period; ties: smallest start,
    then period.  Null without runs."""
    def better(best, r):
        a, b = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best.isNull() | (a > b), r).otherwise(best)   # runs come by start and period
    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)
