"""Removal of repeated substrings by distributed suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else
too.  So for every suffix (every position with ``LENGTH`` bytes after it in its
document) it matters whether another suffix begins with the same ``LENGTH``
bytes, that is whether a neighbour in suffix order does.

A row per suffix would make the shuffle hundreds of times the corpus, so
suffixes travel in runs.  A suffix's *leading token* is the ``TOKEN``-byte string
of least hash (the leftmost of them) within its first ``LENGTH`` bytes.  Equal
suffixes have the same leading token at the same place, and consecutive
suffixes mostly share theirs: a run is a maximal stretch of suffixes with one
leading token, and its bytes hold all of them.

1. Tasks cut their documents into runs and reduce the runs that they find more
   than once themselves to one row (hot passages shrink here).
2. Splitters sampled from the corpus range-partition the runs by leading token;
   buckets sort by (token, run) and compare neighbours, across the boundaries
   of the batches they arrive in.  A run that equals a neighbour is repeated as
   a whole.  A run that stands alone with its token cannot share a suffix with
   any other.  Left are runs that share a token but differ.
3. Their bytes are range-partitioned by token in the same way; each bucket sorts
   their suffixes by multikey quicksort (ternary refinement by eight-byte
   characters) and compares neighbours to the full length.
   A token with very many runs is no single task's work: its suffixes travel
   one by one, keyed by a 128-bit hash of their bytes, and are counted.
4. The spans found are merged per document and cut out.

Runs are told apart by two 64-bit hashes (token and run), suffixes in step 3 by
their bytes (by the 128-bit hash for tokens with very many runs)."""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, ship_package, written

LENGTH = 200
TOKEN = 32
HOT_RUNS = 8192           # differing runs of a token that one task sorts (about 2 MB of text)
SAMPLE_DOCS = 2000        # documents whose tokens give the splitters
_PIECE = 1 << 20          # bytes of documents that a task cuts into runs at a time
_GROUP_BYTES = 1 << 20    # bytes of runs whose suffixes a task sorts at a time (whole tokens)
_MULT = 0x9E3779B97F4A7C15
RUNS = "bucket int, token long, run long, doc long, start long, n int, copies int"


# ---------------------------------------------------------------- runs of suffixes

def token_hashes(b: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every position on."""
    h, span, mult = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9), 1, _MULT
    out, at = None, 0
    left = size
    # Binary decomposition of the size: pieces of 1, 2, 4, ... bytes.
    while left:
        if left & 1:
            n = len(b) - at - span + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            piece = h[at:at + n]
            out = piece.copy() if out is None else out[:n] * np.uint64(pow(_MULT, span, 1 << 64)) + piece
            at += span
        left >>= 1
        if left:
            if len(h) <= span:
                return np.zeros(0, np.uint64)
            h = h[:-span] * np.uint64(mult) + h[span:]
            mult, span = mult * mult % (1 << 64), span * 2
    out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(32))


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (w - span)], x[w - span:]) if span < w else x


def runs_of(b: np.ndarray, starts: np.ndarray, lengths: np.ndarray, length: int, token: int):
    """(first suffix, number of suffixes, token place, text) of the runs of the
    texts joined in ``b`` (fewer than 2**24 bytes a call), and the token hashes."""
    h = token_hashes(b, token)
    w = length - token + 1
    none = np.zeros(0, np.int64)
    if len(b) < length:
        return none, none, none, none, h
    place = np.arange(len(h), dtype=np.uint64)
    low = _window_min((h & np.uint64(0xFFFFFFFFFF000000)) | place, w)
    lead = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(starts)), lengths)[:len(lead)]
    whole = np.arange(len(lead)) + length <= (starts + lengths)[text]
    at = np.flatnonzero(whole)
    if not len(at):
        return none, none, none, none, h
    lead, text = lead[at], text[at]
    first = np.concatenate([[0], np.flatnonzero((np.diff(lead) != 0) | (np.diff(text) != 0)) + 1])
    n = np.diff(np.append(first, len(at)))
    return at[first], n, lead[first], text[first], h


def _pieces(bodies: list[bytes], length: int):
    """(joined bytes, starts, lengths, numbers, offsets) of about ``_PIECE`` bytes;
    a longer body is cut so that each of its suffixes is in one piece."""
    held, size = [], 0
    for i, t in enumerate(bodies):
        for s in range(0, max(1, len(t) - length + 1), _PIECE):
            part = t[s:s + _PIECE + length - 1] if len(t) > _PIECE else t
            if held and size + len(part) > _PIECE + length:
                yield _join(held)
                held, size = [], 0
            held.append((i, s, part))
            size += len(part)
    if held:
        yield _join(held)


def _join(held):
    lens = np.array([len(p) for _, _, p in held], dtype=np.int64)
    return (b"".join(p for _, _, p in held), np.cumsum(lens) - lens, lens,
            np.array([i for i, _, _ in held]), np.array([s for _, s, _ in held], dtype=np.int64))


def run_rows(bodies: list[bytes], length: int, token: int):
    """Arrays (token, run, text, start, n) of all runs of a batch of texts."""
    import xxhash
    hash64 = xxhash.xxh3_64_intdigest
    for joined, starts, lens, number, offset in _pieces(bodies, length):
        first, n, lead, text, h = runs_of(np.frombuffer(joined, np.uint8), starts, lens, length, token)
        if not len(first):
            continue
        view = memoryview(joined)
        run = np.array([hash64(view[a:e]) for a, e in zip(first.tolist(), (first + n + length - 1).tolist())], dtype=np.uint64)
        yield (h[lead].view(np.int64), run.view(np.int64), number[text], first - starts[text] + offset[text], n)


# ---------------------------------------------------------------- multikey quicksort

def multikey_groups(chars: np.ndarray, at: np.ndarray, group: np.ndarray, length: int,
                    shortcut: np.ndarray | None = None) -> np.ndarray:
    """Which of the suffixes ``at`` (positions in ``chars``, the eight-byte
    character from every byte on) share ``length`` bytes and the ``group`` with
    another.

    Multikey quicksort with whole levels at a time: all open groups are ordered
    by the next character, and split where it changes; suffixes left alone are
    done.  ``shortcut`` (a hash of the ``length`` bytes from every position on)
    serves as the character after the first; what it leaves together is compared
    byte by byte, and refined further character by character if it differs."""
    found = np.zeros(len(at), dtype=bool)
    open_ = np.arange(len(at))
    steps = [chars[at]]
    if shortcut is not None:
        steps.append(shortcut[at])
    depths = [*range(0, length - 7, 8), length - 8]
    for key in steps:
        open_, group = _refine(open_, group, key[open_])
    if shortcut is not None and len(open_):
        # Neighbours to the full length.
        same = group[1:] == group[:-1]
        a, b = at[open_[:-1][same]], at[open_[1:][same]]
        equal = np.ones(len(a), dtype=bool)
        for d in depths:
            equal &= chars[a + d] == chars[b + d]
        bad = np.unique(group[1:][same][~equal])
        sure = ~np.isin(group, bad)
        found[open_[sure]] = True
        open_, group = open_[~sure], group[~sure]
    for d in depths:
        if not len(open_):
            break
        open_, group = _refine(open_, group, chars[at[open_] + d])
    found[open_] = True
    return found


def _refine(members: np.ndarray, group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members ordered by (group, key) with the groups split by key; groups of
    one are left out."""
    if not len(members):
        return members, group
    order = np.lexsort((key, group))
    members, group, key = members[order], group[order], key[order]
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])])
    group = np.cumsum(new)
    size = np.bincount(group)[group]
    return members[size > 1], group[size > 1]


def eight_byte_chars(b: np.ndarray) -> np.ndarray:
    """Big-endian integer of the eight bytes from every position on (zeros
    after the end)."""
    v = np.concatenate([b, np.zeros(7, np.uint8)]).astype(np.uint64)
    for span in (1, 2, 4):
        v = v[:-span] << np.uint64(8 * span) | v[span:]
    return v


def repeated_spans(bodies: list[bytes], group: list[int], counts: list[int], length: int, token: int):
    """For runs (bytes, token group, number of suffixes): rows (run number,
    from, to) of the maximal stretches of suffixes that another run of the
    group also has, as byte spans of the run."""
    lens = np.array([len(x) for x in bodies], dtype=np.int64)
    base = np.cumsum(lens) - lens
    b = np.frombuffer(b"".join(bodies), np.uint8)
    n = np.array(counts, dtype=np.int64)
    # Place of the leading token in a run: that of its first suffix.
    h = token_hashes(b, token)
    place = (np.arange(len(b)) - np.repeat(base, lens))[:len(h)].astype(np.uint64)
    key = np.append((h & np.uint64(0xFFFFFFFFFF000000)) | place, np.uint64(0xFFFFFFFFFFFFFFFF))
    ends = np.stack([base, base + length - token + 1], axis=1).ravel()
    lead = (np.minimum.reduceat(key, ends)[::2] & np.uint64(0xFFFFFF)).astype(np.int64)
    run = np.repeat(np.arange(len(n)), n)
    i = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    # Equal suffixes have their token at the same distance.
    key = np.asarray(group, dtype=np.int64)[run] * length + lead[run] - i
    hit = multikey_groups(eight_byte_chars(b), base[run] + i, key, length, token_hashes(b, length))
    run, i = run[hit], i[hit]
    if not len(run):
        return run, i, i
    new = np.concatenate([[True], (np.diff(run) != 0) | (np.diff(i) != 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(run)) - 1
    return run[first], i[first], i[last] + length


# ---------------------------------------------------------------- Spark jobs

def _splitters(docs: DataFrame, parts: int, length: int, token: int) -> np.ndarray:
    """``parts - 1`` token hashes that cut a sample's runs into equal shares."""
    n = docs.count()
    if not n or parts < 2:
        return np.zeros(0, np.int64)
    # The splitters only balance the buckets.
    some = docs.where(F.pmod(F.xxhash64("doc"), F.lit(max(1, n // SAMPLE_DOCS))) == 0)

    def tokens(batches):
        import pyarrow as pa
        for batch in batches:
            for t, *_ in run_rows([x.as_py() for x in batch.column(1)], length, token):
                yield pa.RecordBatch.from_arrays([pa.array(t)], names=["token"])

    found = some.mapInArrow(tokens, "token long")
    q = found.agg(F.percentile_approx("token", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or []
    return np.unique(np.array(q, dtype=np.int64))


def removable_spans(docs: DataFrame, length: int = LENGTH, token: int = TOKEN, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(doc, start, end): spans of bytes that occur elsewhere too, possibly
    overlapping; ``docs`` has unique ``doc`` (long) and ``text`` (binary)."""
    if not 0 < token <= length or length < 8:
        raise ValueError("token must fit into length, length must be 8 or more")
    spark = docs.sparkSession
    ship_package(spark)
    parts = shuffle_partitions(spark)
    cuts = _splitters(docs, parts, length, token)

    def runs(batches):
        import pyarrow as pa
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for t, r, text, start, n in run_rows([x.as_py() for x in batch.column(1)], length, token):
                doc = ids[text]
                # One row stands for the copies of a run in this piece; the
                # copies go straight to their documents (copies = 0).
                order = np.lexsort((r, t))
                new = np.concatenate([[True], (np.diff(t[order]) != 0) | (np.diff(r[order]) != 0)])
                head = order[new]
                copies = np.diff(np.append(np.flatnonzero(new), len(order)))
                rest = order[~new]
                at = np.searchsorted(cuts, t[head], side="right")
                # Copies need no bucket of their own; spread them by document.
                away = ((doc[rest].astype(np.uint64) * np.uint64(_MULT)) >> np.uint64(33)).astype(np.int64) % (len(cuts) + 1)
                rows = np.concatenate([head, rest])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([at, away]).astype(np.int32)), pa.array(t[rows]), pa.array(r[rows]),
                     pa.array(doc[rows]), pa.array(start[rows]), pa.array(n[rows].astype(np.int32)),
                     pa.array(np.concatenate([copies, np.zeros(len(rest))]).astype(np.int32))],
                    names=[x.split()[0] for x in RUNS.split(", ")])

    found = docs.select("doc", "text").mapInArrow(runs, RUNS)
    ranged = found.repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions("token", "run", "doc", "start")
    kinds = "doc long, start long, n int, token long, whole boolean, compare boolean, hot boolean"
    sorted_ = written(ranged.mapInArrow(partial(_compare_neighbours, hot_runs=hot_runs), kinds), "suffix-runs")

    # Bytes of the runs that share their token with others; of hot tokens, the
    # hash of every suffix.
    wanted = (sorted_.where("compare").groupBy("doc")
              .agg(F.collect_list(F.struct("start", "n", "token", "whole", "hot")).alias("runs")))
    with_text = docs.join(wanted, "doc")
    body_schema = "token long, doc long, start long, n int, whole boolean, body binary, h1 long, h2 long"

    def bodies(batches):
        import pyarrow as pa
        import xxhash
        digest = xxhash.xxh3_128_digest
        types = [*[pa.int64()] * 3, pa.int32(), pa.bool_(), pa.binary(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in body_schema.split(", ")]
        for batch in batches:
            rows = []
            for doc, text, of in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = memoryview(text.as_py())
                for x in of:
                    a, n = x["start"], x["n"]
                    if not x["hot"]:
                        rows.append((x["token"], doc, a, n, x["whole"], bytes(text[a:a + n + length - 1]), None, None))
                    else:
                        for i in range(a, a + n):
                            h = digest(text[i:i + length])
                            rows.append((x["token"], doc, i, 1, x["whole"], None, int.from_bytes(h[:8], "big", signed=True),
                                         int.from_bytes(h[8:], "big", signed=True)))
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names=names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names=names)

    # Stored: the range partitioning below reads it twice.
    rows = written(with_text.select("doc", "text", "runs").mapInArrow(bodies, body_schema), "suffix-bodies")
    compared = rows.where("body IS NOT NULL").select("token", "doc", "start", "n", "whole", "body").repartitionByRange(
        "token").sortWithinPartitions("token")

    def quicksort(batches):
        import pyarrow as pa
        for rows in _whole_tokens(batches):
            group = np.unique(rows["token"], return_inverse=True)[1]
            run, a, e = repeated_spans(rows["body"], group, rows["n"], length, token)
            # A run that is repeated as a whole is settled already.
            ok = ~np.asarray(rows["whole"], dtype=bool)[run]
            run, a, e = run[ok], a[ok], e[ok]
            start = np.asarray(rows["start"], dtype=np.int64)[run]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(rows["doc"], dtype=np.int64)[run]), pa.array(start + a), pa.array(start + e)],
                names=["doc", "start", "end"])

    spans = compared.mapInArrow(quicksort, "doc long, start long, end long")
    hot = rows.where("body IS NULL")
    twice = hot.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    spans = spans.unionByName(hot.where("not whole").join(twice, ["h1", "h2"], "left_semi").select(
        "doc", "start", (F.col("start") + length).alias("end")))
    whole = sorted_.where("whole").select("doc", "start", (F.col("start") + F.col("n") + length - 1).alias("end"))
    return whole.unionByName(spans)


def _compare_neighbours(batches, hot_runs: int):
    """From runs sorted by (token, run): which are repeated as a whole, and of
    which the bytes must be compared (one of each run, of tokens with several;
    ``hot`` if there are more than ``hot_runs``).

    Holds at most ``hot_runs`` rows back, whatever the size of a group: the
    first row of the current run, with whether it was repeated and its token
    shared, and the token's rows to compare so far."""
    import pyarrow as pa
    names = ["doc", "start", "n", "token", "whole", "compare", "hot"]
    held = None     # [doc, start, n, token, run, whole, token has several runs]
    waiting: list[tuple] = []   # rows to compare of the current token
    hot = False

    def batch_of(rows):
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def close(rows, last_of_token):
        nonlocal waiting, hot
        if held is not None and held[6]:
            waiting.append((held[0], held[1], held[2], held[3], held[5], True))
        elif held is not None and held[5]:
            rows.append((held[0], held[1], held[2], held[3], True, False, False))
        hot = hot or len(waiting) > hot_runs
        if hot or last_of_token:
            rows += [(*w, hot) for w in waiting]
            waiting = []
        if last_of_token:
            hot = False

    for batch in batches:
        t, r, doc, start, n, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(1, 7))
        settled = copies == 0
        if settled.any():
            k = int(settled.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[settled]), pa.array(start[settled]), pa.array(n[settled]), pa.array(t[settled]),
                 pa.array(np.ones(k, bool)), pa.array(np.zeros(k, bool)), pa.array(np.zeros(k, bool))], names=names)
        t, r, doc, start, n, copies = (x[~settled] for x in (t, r, doc, start, n, copies))
        if not len(t):
            continue
        # Runs alone with their token inside the batch are done without a loop.
        near = np.ones(len(t), dtype=bool)
        near[1:-1] = (t[1:-1] == t[:-2]) | (t[1:-1] == t[2:]) | (copies[1:-1] > 1)
        rows: list[tuple] = []
        for a, b, d, s, k, c in zip(t[near].tolist(), r[near].tolist(), doc[near].tolist(), start[near].tolist(),
                                    n[near].tolist(), copies[near].tolist()):
            if held is not None and held[3] == a and held[4] == b:
                held[5] = True
                rows.append((d, s, k, a, True, False, False))
                continue
            shared = held is not None and held[3] == a
            if shared:
                held[6] = True
            close(rows, not shared)
            held = [d, s, k, a, b, c > 1, shared]
        if rows:
            yield batch_of(rows)
    rows = []
    close(rows, True)
    if rows:
        yield batch_of(rows)


def _whole_tokens(batches):
    """Columns of consecutive rows, cut between tokens, of about
    ``_GROUP_BYTES`` bytes of runs."""
    names = ["token", "doc", "start", "n", "whole", "body"]
    held: dict[str, list] = {c: [] for c in names}
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in range(6))):
            if size >= _GROUP_BYTES and row[0] != held["token"][-1]:
                yield held
                held, size = {c: [] for c in names}, 0
            for c, v in zip(names, row):
                held[c].append(v)
            size += len(row[5])
    if held["token"]:
        yield held


def _merge_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, e in sorted((x["start"], x["end"]) for x in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([a, e])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   token: int = TOKEN, hot_runs: int = HOT_RUNS) -> DataFrame:
    """A row per document: (id, n_bytes, n_removed, n_spans, kept_sha256, kept):
    ``kept`` is the text without its repeated bytes, as binary.

    Null texts are empty; texts shorter than ``length`` bytes stay whole.  Every
    row is a document of its own, also where ids are null or repeated (such
    tables are written once with numbers in place of the ids)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc"),
                         F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    names = None
    if source.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc IS NULL").limit(1).count():
        numbered = written(source.select(F.col("doc").alias("id"), F.monotonically_increasing_id().alias("doc"), "text"),
                           "suffix-numbered")
        names, source = numbered.select(F.col("doc").alias("_doc"), F.col("id").alias("_id")), numbered.select("doc", "text")
    spans = removable_spans(source, length, token, hot_runs).groupBy("doc").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = source.join(spans, "doc", "left")

    def cut(batches):
        import pyarrow as pa
        for batch in batches:
            rows = []
            for doc, text, of in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py()
                merged = _merge_spans(of)
                edges = [0, *(x for s in merged for x in s), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((doc, len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept))
            if rows:
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = joined.mapInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    if names is None:
        return out
    return out.join(names, F.col("id") == F.col("_doc")).select(F.col("_id").alias("id"), *out.columns[1:])
