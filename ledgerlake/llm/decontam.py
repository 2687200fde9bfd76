"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared in normal form: lower case, runs of other characters than
letters and digits as one space.  Looked for are the windows of ``WINDOW``
characters at every place of a benchmark item (the whole item if it is shorter).
If a stretch of a document is within ``k`` edits of a window of ``m`` characters,
the two share at least ``m + 1 - q - k*q`` character q-grams, and the diagonals
(document position minus item position) of these lie within ``k`` of each other.
So an item's shared q-grams are counted in overlapping diagonal bands; windows
that reach the bound in a band are aligned within the band, and count as leaks
if the alignment needs at most ``k`` edits.  Items under ``SHORT`` characters,
whose bound says little, leak where their whole normal form stands between word
borders.  Hence every verbatim part of ``WINDOW`` characters of an item is found,
and every item of any length that is there as a whole.

The benchmark is the query side: its index is cut into blocks of bounded size,
stored in the shared folder; a task normalises a group of documents once and
takes it through all blocks.  Documents are never shuffled and read once.  Where
many items share q-grams (one instruction before ten thousand questions), the
matches of a stretch are worked through in slices of at most ``HITS``: by text
first, then by items; none is left out.

Defined cases.  Null texts hold nothing; null items and items without letters
and digits are not searched.  Rows that repeat an id are reported each; an item
id that repeats is reported once a document.  Long texts are cut into
overlapping parts.  The input's other columns do not matter."""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory, scratch_dir, ship_package, task_fs

Q = 8
WINDOW = 80             # characters of an item that are looked for at a time
EDITS_PER = 20          # one edit allowed for so many characters of a window
SHORT = 32              # shorter items (in normal form) are found as a whole only
BAND = 8                # width of half a diagonal band; at least the edits of a window
BLOCK_CHARS = 4 << 20   # benchmark characters that tasks hold at a time
HITS = 1 << 20          # shared q-grams that a task holds at a time
_PIECE = 1 << 20        # document characters that a task compares at a time
_GROUP = 1 << 20        # document characters that go through the index together
_GROUP_OF_BLOCKS = 16 << 20    # where it has several blocks, each loaded for a group
_FILTER_BITS = 22
LEAKS = "doc_id long, item_id long, edits int, first_char long, item_char long, n_chars long"


@lru_cache(1)
def _word_chars() -> np.ndarray:
    """Whether a code point is a letter or digit."""
    return np.array([chr(c).isalnum() for c in range(0x110000)], dtype=bool)


def normalise(text: str) -> np.ndarray:
    """Code points of the normal form."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    solid = _word_chars()[a]
    keep = solid.copy()
    keep[1:] |= solid[:-1]              # the first of a run of others becomes the space
    out = np.where(solid, a, np.uint32(32))[keep]
    return out[:-1] if len(out) and out[-1] == 32 else out


def qgram_hashes(a: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the q-gram at every position (``q`` a power of two)."""
    h = (a.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mult, span = 0x9E3779B97F4A7C15, 1
    while span < q:
        if len(h) <= span:
            return np.zeros(0, np.uint64)
        h = h[:-span] * np.uint64(mult) + h[span:]
        mult, span = mult * mult % (1 << 64), span * 2
    h ^= h >> np.uint64(31)
    return h * np.uint64(0x94D049BB133111EB)


_BASE = 0x9E3779B97F4A7C15        # odd: has an inverse modulo 2^64
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _stretch_hashes(a: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` characters from each start."""
    sums = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9) * _powers(_BASE, len(a)), out=sums[1:])
    return (sums[start + length] - sums[start]) * _powers(_BACK, len(a) + 1)[start]


@dataclass
class Index:
    """A block of items: their joined characters; the q-grams of the long ones
    as sorted hashes, and the places of each (hash number * characters + place,
    sorted); the short ones by length and hash."""
    item_ids: np.ndarray
    item_start: np.ndarray
    item_len: np.ndarray
    chars: np.ndarray
    hashes: np.ndarray
    place: np.ndarray
    bitmap: np.ndarray
    short_len: np.ndarray
    short_hash: np.ndarray
    short_item: np.ndarray

    def save(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f.name: getattr(self, f.name) for f in fields(self)})
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Index:
        with np.load(io.BytesIO(data)) as z:
            return Index(**{k: z[k] for k in z.files})


def build_index(items: list[tuple[int, str]]) -> Index | None:
    ids, parts, starts, at = [], [], [], 0
    for item_id, text in items:
        a = normalise(text)
        if not len(a):
            continue
        ids.append(item_id)
        starts.append(at)
        parts += [a, np.zeros(1, np.uint32)]
        at += len(a) + 1
    if not ids:
        return None
    chars, start = np.concatenate(parts), np.array(starts, dtype=np.int64)
    length = np.diff(np.append(start, at)) - 1
    h = qgram_hashes(chars)
    p = np.arange(len(h))
    owner = np.searchsorted(start, p, side="right") - 1
    inside = (length[owner] >= SHORT) & (p + Q <= start[owner] + length[owner])
    h, p = h[inside], p[inside]
    unique, number = np.unique(h, return_inverse=True)
    bitmap = np.zeros(1 << _FILTER_BITS, dtype=bool)
    bitmap[(unique >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    short = np.flatnonzero(length < SHORT)
    hashed = np.zeros(len(short), dtype=np.uint64)
    for m in np.unique(length[short]):
        of = length[short] == m
        hashed[of] = _stretch_hashes(chars, start[short[of]], int(m))
    return Index(np.array(ids, dtype=np.int64), start, length, chars, unique, np.sort(number.astype(np.int64) * len(chars) + p),
                 bitmap, length[short], hashed, short)


def banded_edits(doc: np.ndarray, probe: np.ndarray, diag: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits between each probe (a row of ``probe``) and a stretch of
    ``doc`` whose diagonals lie in [diag, diag + width), and where it ends."""
    n, m = probe.shape
    offs = np.arange(width)
    cost = np.zeros((n, width), dtype=np.int32)   # the stretch may start anywhere in the band
    for i in range(m):
        at = diag[:, None] + offs[None, :] + i
        inside = (at >= 0) & (at < len(doc))
        c = np.where(inside, doc[np.clip(at, 0, len(doc) - 1)], np.uint32(0xFFFFFFFF))
        nxt = cost + (c != probe[:, i, None])
        np.minimum(nxt[:, :-1], cost[:, 1:] + 1, out=nxt[:, :-1])      # probe character left out
        cost = np.minimum.accumulate(nxt - offs, axis=1) + offs          # document character left out
    end = cost.argmin(axis=1)
    return cost[np.arange(n), end], diag + end + m


def short_leaks(chars: np.ndarray, idx: Index) -> tuple[np.ndarray, np.ndarray]:
    """(place, item): where a short item stands between word borders."""
    edge = np.concatenate([[True], (chars == 32) | (chars == 0), [True]])
    start = np.flatnonzero(edge[:-2] & ~edge[1:-1])
    places, items = [], []
    for m in np.unique(idx.short_len):
        at = start[start + m <= len(chars)]
        at = at[edge[at + m + 1]]
        if not len(at):
            continue
        of = np.flatnonzero(idx.short_len == m)
        of = of[np.argsort(idx.short_hash[of], kind="stable")]
        known, h = idx.short_hash[of], _stretch_hashes(chars, at, int(m))
        low, high = np.searchsorted(known, h), np.searchsorted(known, h, side="right")
        p = np.repeat(at, high - low)
        item = idx.short_item[of[np.repeat(low, high - low) + _count_up(high - low)]]
        same = (chars[p[:, None] + np.arange(m)] == idx.chars[idx.item_start[item][:, None] + np.arange(m)]).all(axis=1)
        places.append(p[same])
        items.append(item[same])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *items])


def _count_up(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each group of the given sizes."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def find_leaks(chars: np.ndarray, owner_of: np.ndarray, idx: Index) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, item, edits, begin, item place) of verified windows in ``chars``,
    several texts joined with zeros between them; ``owner_of`` holds where each
    starts.  In slices; of an item near one diagonal at least one window."""
    h = qgram_hashes(chars)
    if not len(h) or not len(idx.hashes):
        return
    pos = np.flatnonzero(idx.bitmap[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    g = np.minimum(np.searchsorted(idx.hashes, h[pos]), len(idx.hashes) - 1)
    ok = idx.hashes[g] == h[pos]
    pos, g = pos[ok], g[ok]
    overlap = WINDOW + 4 * BAND
    todo = [(0, len(chars), 0, len(idx.item_ids))]
    while todo:
        begin, end, low, high = todo.pop()
        part = slice(np.searchsorted(pos, begin), np.searchsorted(pos, end))
        if part.start == part.stop:
            continue
        base = g[part] * len(idx.chars)
        stop = idx.item_start[high] if high < len(idx.item_ids) else len(idx.chars)
        first = np.searchsorted(idx.place, base + idx.item_start[low])
        count = np.searchsorted(idx.place, base + stop) - first
        total = int(count.sum())
        if total > HITS and end - begin > 3 * overlap:
            middle = (begin + end) // 2
            todo += [(begin, middle + overlap, low, high), (middle, end, low, high)]
        elif total > HITS and high - low > 1:
            middle = (low + high) // 2
            todo += [(begin, end, low, middle), (begin, end, middle, high)]
        elif total:
            p = np.repeat(pos[part], count)
            post = idx.place[np.repeat(first, count) + _count_up(count)] - np.repeat(base, count)
            yield from _verified(chars, owner_of, idx, p, post)


def _verified(chars, owner_of, idx: Index, p: np.ndarray, post: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """The windows that hold, for shared q-grams at ``p`` and item places ``post``."""
    shift = len(idx.chars) + 2 * BAND
    band = (p - post + shift) // BAND           # a band has 2 * BAND diagonals
    band, p, post = np.concatenate([band, band - 1]), np.tile(p, 2), np.tile(post, 2)
    # A first, coarse count: no window asks for fewer.
    band, p, post = _frequent(band, int(_need(np.arange(SHORT, WINDOW + 1)).min()), band, p, post)
    text = np.searchsorted(owner_of, p, side="right") - 1
    item = np.searchsorted(idx.item_start, post, side="right") - 1
    order = np.lexsort((post, band, item, text))
    text, item, band, post = text[order], item[order], band[order], post[order]
    if not len(post):
        return
    new = np.ones(len(post), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
    fresh = new.copy()
    fresh[1:] |= post[1:] != post[:-1]          # a place counts once
    text, item, band, post, new = text[fresh], item[fresh], band[fresh], post[fresh], new[fresh]
    key = np.cumsum(new) - 1
    size = np.minimum(idx.item_len[item], WINDOW)
    need = _need(size)
    last = np.arange(len(post)) + need - 1      # the hit that fills a window from this one on
    enough = last < len(post)
    last = np.minimum(last, len(post) - 1)
    enough &= (key[last] == key) & (post[last] - post <= size - Q)
    if not enough.any():
        return
    # Starts of the windows that hold these hits.
    begin = idx.item_start[item]
    low = np.maximum(post[last] - (size - Q), begin)[enough]
    high = np.minimum(post, begin + idx.item_len[item] - size)[enough]
    low = np.minimum(low, high)
    key, text, item, band, size = (x[enough] for x in (key, text, item, band, size))
    # One window of every band first: where it holds, the others need no look.
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    middle = head + np.diff(np.append(head, len(key))) // 2
    rows = _aligned(chars, idx, text[middle], item[middle], band[middle], size[middle], (low[middle] + high[middle]) // 2, shift)
    yield rows[:-1]
    left = np.ones(int(key[-1]) + 1, dtype=bool)
    left[key[middle[rows[-1]]]] = False
    some = np.flatnonzero(left[key])
    for part in np.array_split(some, max(1, len(some) // 4096)):
        n = high[part] - low[part] + 1
        at = np.repeat(part, n)
        yield _aligned(chars, idx, text[at], item[at], band[at], size[at], low[at] + _count_up(n), shift)[:-1]


def _need(size: np.ndarray) -> np.ndarray:
    """Shared q-grams of a window of so many characters within its edits."""
    return size + 1 - Q - size // EDITS_PER * Q


def _aligned(chars, idx: Index, text, item, band, size, place, shift) -> tuple[np.ndarray, ...]:
    """(text, item, edits, begin, item place, which) of the windows within their edits."""
    out = [tuple(np.zeros(0, np.int64) for _ in range(6))]
    for m in np.unique(size):
        same = np.flatnonzero(size == m)
        for part in np.array_split(same, max(1, len(same) // 20_000)):
            body = idx.chars[place[part, None] + np.arange(m)]
            edits, end = banded_edits(chars, body, band[part] * BAND - shift + place[part], 2 * BAND)
            good = edits <= m // EDITS_PER
            of = part[good]
            out.append((text[of], item[of], edits[good], end[good] - m, place[of] - idx.item_start[item[of]], of))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out))


def _frequent(key: np.ndarray, least: int, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of ``columns`` whose key occurs at least ``least`` times."""
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    ok = count[inverse] >= least
    return tuple(c[ok] for c in columns)


def _texts_in_pieces(texts: list[np.ndarray]):
    """(joined characters, starts, text numbers, offsets in the text) in pieces
    of about ``_PIECE`` characters; a longer text is cut with an overlap that no
    region exceeds, and a mark at the cut that is neither space nor letter."""
    overlap = WINDOW + 4 * BAND
    cut = np.ones(1, np.uint32)
    held, size = [], 0
    for i, a in enumerate(texts):
        for s in range(0, max(1, len(a) - overlap), _PIECE):
            end = s + _PIECE + overlap
            part = np.concatenate([cut[:s > 0], a[s:end], cut[:end < len(a)]])
            if held and size + len(part) > _PIECE + overlap:
                yield _joined(held)
                held, size = [], 0
            held.append((i, s - (s > 0), part))
            size += len(part) + BAND
    if held:
        yield _joined(held)


def _joined(held):
    gap = np.zeros(BAND, np.uint32)   # costs more edits than any window may have
    starts = np.cumsum([0] + [len(p) + BAND for _, _, p in held[:-1]])
    return (np.concatenate([x for _, _, p in held for x in (p, gap)]), starts,
            np.array([i for i, _, _ in held]), np.array([s for _, s, _ in held]))


def leaks_of(ids: list, texts: list[str], blocks: Iterator[Index]) -> list[tuple]:
    """Rows of ``LEAKS`` for a batch of documents: per document and item the
    window of the fewest edits, then the first."""
    best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    prepared = list(_texts_in_pieces([normalise(t) for t in texts]))

    def note(doc, item_id, *found):
        old = best.get((doc, item_id))
        best[doc, item_id] = found if old is None else min(old, found)

    for idx in blocks:
        for chars, starts, number, offset in prepared:
            for rows in find_leaks(chars, starts, idx):
                for t, i, e, begin, place in zip(*(x.tolist() for x in rows)):
                    note(int(number[t]), int(idx.item_ids[i]), e, max(0, begin - int(starts[t]) + int(offset[t])), place,
                         min(int(idx.item_len[i]), WINDOW))
            places, items = short_leaks(chars, idx)
            owner = np.searchsorted(starts, places, side="right") - 1
            for p, i, t in zip(places.tolist(), items.tolist(), owner.tolist()):
                note(int(number[t]), int(idx.item_ids[i]), 0, p - int(starts[t]) + int(offset[t]), 0, int(idx.item_len[i]))
    return [(ids[d], item, *found) for (d, item), found in sorted(best.items())]


# ---------------------------------------------------------------- operator

def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS):
    """The items in lists of at most ``block_chars`` characters (or one longer
    item), a block in the driver at a time."""
    items = benchmark.select(F.col(id_col).cast("long"), text_col).where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    block, size = [], 0
    for item_id, text in items.orderBy(id_col, text_col).toLocalIterator():
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield block


class Blocks:
    """The stored index, a block in a worker's memory at a time."""

    def __init__(self, uris: list[str]):
        self.uris, self.held = uris, None

    def __iter__(self) -> Iterator[Index]:
        # From the one at hand: a single block is loaded once.
        order = range(len(self.uris))
        if self.held:
            order = [(self.held[0] + k) % len(self.uris) for k in order]
        for n in order:
            if not self.held or self.held[0] != n:
                self.held = None
                fs, path = task_fs(self.uris[n])
                with fs.open_input_stream(path) as f:
                    self.held = n, Index.load(f.read())
            yield self.held[1]


def store_index(benchmark: DataFrame, block_chars: int = BLOCK_CHARS, **columns) -> list[str]:
    """Write the index, a file a block, and return where."""
    spark = benchmark.sparkSession
    folder, uris = scratch_dir(spark, "benchmark-index"), []
    fs, path = task_fs(folder)
    fs.create_dir(path, recursive=True)
    for block in benchmark_blocks(benchmark, block_chars=block_chars, **columns):
        idx = build_index(block)
        if idx is not None:
            with fs.open_output_stream(f"{path}/{len(uris)}.npz") as f:
                f.write(idx.save())
            uris.append(f"{folder}/{len(uris)}.npz")
    return uris


def _groups(texts: list[str], blocks: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about a group's characters, or of one longer text."""
    most, i = _GROUP if blocks == 1 else _GROUP_OF_BLOCKS, 0
    while i < len(texts):
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j]) <= most):
            held += len(texts[j])
            j += 1
        yield i, j
        i = j


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row per document and benchmark item found in it: (doc_id, item_id,
    edits, first_char, item_char, n_chars), the best window and where it is in
    the document and the item; positions count characters of the normal form."""
    spark = docs.sparkSession
    ship_package(spark)
    uris = store_index(benchmark, block_chars, id_col=item_col, text_col=item_text_col)
    if not uris:
        return spark.createDataFrame([], LEAKS)

    def search(batches):
        import pyarrow as pa
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in LEAKS.split(", ")]
        blocks = Blocks(uris)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in _groups(texts, len(uris)):
                rows = leaks_of(ids[i:j], texts[i:j], blocks)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
            del texts
            release_memory()

    return docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).mapInArrow(search, LEAKS)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_chars: int = BLOCK_CHARS,
                      **columns) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, unchanged."""
    ship_package(docs.sparkSession)
    uris = store_index(benchmark, block_chars, **columns)
    if not uris:
        return docs

    @F.pandas_udf("boolean")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        blocks = Blocks(uris)
        for texts in parts:
            texts = [t or "" for t in texts]
            bad = {r[0] for i, j in _groups(texts, len(uris)) for r in leaks_of(list(range(i, j)), texts[i:j], blocks)}
            yield pd.Series([i not in bad for i in range(len(texts))], dtype=bool)
            del texts
            release_memory()

    return docs.where(clean(F.col(text_col).cast("string")))
