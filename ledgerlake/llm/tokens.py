"""Token-id output as directly addressable codes (DAC), and its reader.

A shard file holds consecutive documents.  Each id is cut into chunks of
``CHUNK_BITS`` bits; level 0 holds the low chunk of every id, level ``l`` the
next chunk of those ids that have one, in the same order.  A bitmap per level
marks the ids that go on to the next level, with a rank directory (set bits
before every ``RANK_BLOCK`` entries).  Entry ``i`` of a level continues at entry
``rank(i)`` of the next, so any id is found by one rank a level, without
decoding what stands before it.

File, all integers little-endian:

    b"DACTOK1\\0" | u64 header length | JSON header | sections, 8-byte aligned

The header names each section's offset, type and length: ``doc_id`` (i8),
``has_id`` (u1), ``bound`` (i8, n_docs + 1: first token of each document), and
for each level ``chunk{l}`` (u1), ``more{l}`` (bitmap), ``rank{l}`` (u4).

Shards are written by the tasks that hold a range of the order, under names
that no other attempt uses; the manifest, a table written by Spark, lists those
of the attempts that counted.  A lost executor leaves at most an unlisted file."""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release_memory, scratch_dir, ship_package, shuffle_partitions, task_fs

MAGIC = b"DACTOK1\0"
CHUNK_BITS = 8
RANK_BLOCK = 512
SHARD_TOKENS = 1 << 24
# Words whose ids a worker remembers (bounds its memory, not the result).
WORD_CACHE = 1 << 18
CACHED_BYTES = 64        # longer words are encoded each time: with the number of words this bounds the cache
MANIFEST = "part long, seq long, file string, n_docs long, n_tokens long, n_bytes long"


# ---------------------------------------------------------------- encoding

# Words of ASCII and Latin-1 letters, digits and marks, without an apostrophe:
# lower case is one character for one, nothing composes, and they fall into
# runs of letters, single digits and runs of other marks.
_PLAIN = re.compile(rb"(?:[\x21-\x26\x28-\x7e]|\xc3[\x80-\xbf])+")
_RUNS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")
# What the tokenizer's own pattern must be for that.
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _byte_characters() -> list[str]:
    """The character that byte-level BPE writes for each byte: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class WordEncoder(dict):
    """word -> its ids as little-endian u32 bytes, by the tokenizers library.

    For tokenizers that cut texts at white space before anything else and
    drop it, the ids of a text are those of its words one after the other.
    The library encodes each word once; words beyond the bound are encoded
    each time they occur.  With ``runs`` plain words are cut here as the
    tokenizer's pattern would and go to the library's BPE model directly."""

    def __init__(self, tokenizer, bound: int, runs: bool = False):
        super().__init__()
        self.tokenizer, self.bound, self.runs = tokenizer, bound, runs
        self.model, self.pieces = tokenizer.model, {}
        self.chars = _byte_characters()

    def whole(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        out = self.pieces.get(piece)
        if out is None:
            chars = self.chars
            tokens = self.model.tokenize("".join([chars[b] for b in piece.encode("utf-8")]))
            out = b"".join([t.id.to_bytes(4, "little") for t in tokens])
            if len(self.pieces) < self.bound and len(piece) <= CACHED_BYTES:
                self.pieces[piece] = out
        return out

    def __missing__(self, word: bytes) -> bytes:
        if self.runs and _PLAIN.fullmatch(word) and b"<|" not in word:
            out = b"".join(map(self.piece, _RUNS.findall(word.decode("utf-8").lower())))
        else:
            out = self.whole(word)
        if len(self) < self.bound and len(word) <= CACHED_BYTES:
            self[word] = out
        return out

    def text(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


_ENCODERS: dict = {}


def encoder(path: str):
    """Function from UTF-8 bytes to u32 id bytes; kept for the worker's life."""
    if path not in _ENCODERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        if splits_on_space(path):
            _ENCODERS[path] = WordEncoder(tok, WORD_CACHE, cuts_runs(path)).text
        else:
            _ENCODERS[path] = lambda t: np.array(
                tok.encode(t.decode("utf-8"), add_special_tokens=False).ids, dtype="<u4").tobytes()
    return _ENCODERS[path]


def splits_on_space(path: str) -> bool:
    """Whether white space only separates words for this tokenizer: a Split
    that keeps matches of a pattern without white space, no added token with
    white space or padding rules, and no normaliser that looks across it."""
    with open(path, encoding="utf-8") as f:
        conf = json.load(f)
    norm = conf.get("normalizer") or {}
    steps = norm.get("normalizers", [norm] if norm else [])
    known = all(s["type"] in ("NFC", "Lowercase") or (s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"}
                                                      and s["content"] == " ") for s in steps)
    pre = conf.get("pre_tokenizer") or {}
    cuts = pre.get("pretokenizers", [pre])
    first = cuts[0] if cuts else {}
    drops = (first.get("type") == "Split" and first.get("invert") is True and first.get("behavior") == "Removed"
             and "[^\\s" in first["pattern"].get("Regex", "") and " " not in first["pattern"]["Regex"]
             and not any(c.get("add_prefix_space") for c in cuts))
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]]
                    for t in conf.get("added_tokens", []))
    return known and drops and plain and conf.get("truncation") is None and conf.get("post_processor") is None


def cuts_runs(path: str) -> bool:
    """Whether the tokenizer lowers its words and cuts them by ``WORD_PATTERN``
    into pieces for a byte-level BPE model."""
    with open(path, encoding="utf-8") as f:
        conf = json.load(f)
    steps = [x["type"] for x in (conf.get("normalizer") or {}).get("normalizers", [])]
    cuts = (conf.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (steps == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": WORD_PATTERN} and not cuts[1].get("use_regex", True)
            and conf["model"]["type"] == "BPE" and not conf["model"].get("byte_fallback"))


# ---------------------------------------------------------------- file format

def _rank_directory(bits: np.ndarray) -> np.ndarray:
    n = len(bits)
    pad = np.zeros(-n % RANK_BLOCK, dtype=np.uint8)
    per = np.concatenate([bits, pad]).reshape(-1, RANK_BLOCK).sum(axis=1, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(per)]).astype("<u4")


def encode_shard(doc_ids: list, bounds: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one shard; ``bounds[d]`` is the first token of document d."""
    sections = [("doc_id", np.array([0 if d is None else d for d in doc_ids], dtype="<i8")),
                ("has_id", np.array([d is not None for d in doc_ids], dtype="u1")),
                ("bound", np.asarray(bounds, dtype="<i8"))]
    left, level = np.asarray(ids, dtype="<u4"), 0
    while level == 0 or len(left):
        more = (left >> np.uint32(CHUNK_BITS)) > 0
        sections += [(f"chunk{level}", (left & np.uint32((1 << CHUNK_BITS) - 1)).astype("u1")),
                     (f"more{level}", np.packbits(more, bitorder="little")),
                     (f"rank{level}", _rank_directory(more.view(np.uint8)))]
        left, level = left[more] >> np.uint32(CHUNK_BITS), level + 1
    where, at, parts = {}, 0, []
    for name, a in sections:
        raw = a.tobytes()
        where[name] = [at, a.dtype.str, len(a)]
        raw += b"\0" * (-len(raw) % 8)
        parts.append(raw)
        at += len(raw)
    head = json.dumps({"n_docs": len(doc_ids), "n_tokens": int(len(ids)), "levels": level,
                       "chunk_bits": CHUNK_BITS, "rank_block": RANK_BLOCK, "sections": where}).encode()
    head += b" " * (-len(head) % 8)
    return b"".join([MAGIC, struct.pack("<Q", len(head)), head, *parts])


class Shard:
    """Random access to a shard held in a buffer (bytes or a memory map)."""

    def __init__(self, buf):
        self.buf = memoryview(buf)
        if bytes(self.buf[:8]) != MAGIC:
            raise ValueError("not a DAC token file")
        n = struct.unpack("<Q", self.buf[8:16])[0]
        self.head = json.loads(bytes(self.buf[16:16 + n]))
        self.base = 16 + n
        self.n_docs, self.n_tokens = self.head["n_docs"], self.head["n_tokens"]
        self.levels = [(self._at(f"chunk{k}"), self._at(f"more{k}"), self._at(f"rank{k}"))
                       for k in range(self.head["levels"])]
        self.bound = self._at("bound")

    def _at(self, name: str) -> np.ndarray:
        at, kind, n = self.head["sections"][name]
        return np.frombuffer(self.buf, dtype=kind, count=n, offset=self.base + at)

    def doc_ids(self) -> list:
        return [int(d) if ok else None for d, ok in zip(self._at("doc_id"), self._at("has_id"))]

    def _rank(self, level: int, i: int) -> int:
        """Set bits of the level's bitmap before entry ``i``."""
        _, more, rank = self.levels[level]
        block = i // RANK_BLOCK
        a = block * RANK_BLOCK
        bits = np.unpackbits(more[a // 8:(i + 7) // 8], bitorder="little")[: i - a]
        return int(rank[block]) + int(bits.sum())

    def slice(self, i: int, j: int) -> np.ndarray:
        """Ids ``i`` to ``j - 1``, reading only their entries of each level."""
        if i >= j:
            return np.zeros(0, dtype="<u4")
        out = np.zeros(j - i, dtype="<u4")
        where = np.arange(j - i)
        for level, (chunk, more, _) in enumerate(self.levels):
            out[where] |= chunk[i:j].astype("<u4") << np.uint32(CHUNK_BITS * level)
            bits = np.unpackbits(more[i // 8:(j + 7) // 8], bitorder="little")[i % 8:][: j - i].astype(bool)
            where = where[bits]
            if not len(where):
                break
            i = self._rank(level, i)
            j = i + len(where)
        return out

    def token(self, i: int) -> int:
        """Id ``i`` of the shard: one rank a level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for level, (chunk, more, _) in enumerate(self.levels):
            value |= int(chunk[i]) << (CHUNK_BITS * level)
            if not more[i // 8] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def document(self, d: int) -> np.ndarray:
        return self.slice(int(self.bound[d]), int(self.bound[d + 1]))


# ---------------------------------------------------------------- Spark jobs

def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2, order: list[Column] | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode every whole text, append ``end_id``, write shards under ``folder``
    in ascending order of ``order`` (default: the id column, nulls first; rows
    that repeat an id by their text's hash) and return the manifest, one row a
    shard: (part, seq, file, n_docs, n_tokens, n_bytes, start).

    Null texts are empty.  An empty table gives no shard."""
    spark = docs.sparkSession
    ship_package(spark)
    order = order or [F.col(id_col)]
    keys = [c.alias(f"_k{i}") for i, c in enumerate(order)]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
                       F.xxhash64(text_col).alias("_h"), *keys)
    by = [f"_k{i}" for i in range(len(order))] + ["_h"]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("id", "text")
    end = np.array([end_id], dtype="<u4").tobytes()

    def shards(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        encode, seq = encoder(tokenizer_path), 0
        fs, path = task_fs(folder)
        ids, coded, held = [], [], 0

        def flush():
            nonlocal ids, coded, held, seq
            lengths = np.array([len(c) // 4 for c in coded], dtype=np.int64)
            joined, coded = b"".join(coded), []
            raw = encode_shard(ids, np.concatenate([[0], np.cumsum(lengths)]), np.frombuffer(joined, dtype="<u4"))
            del joined
            name = f"{part:06d}-{seq:05d}-{uuid.uuid4().hex}.dac"
            fs.create_dir(path, recursive=True)
            with fs.open_output_stream(f"{path}/{name}") as f:
                f.write(raw)
            row = [part, seq, name, len(ids), held, len(raw)]
            ids, coded, held, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row],
                                              names=["part", "seq", "file", "n_docs", "n_tokens", "n_bytes"])

        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                c = encode(t.as_py()) + end
                ids.append(d)
                coded.append(c)
                held += len(c) // 4
                if held >= shard_tokens:
                    yield flush()
        if ids:
            yield flush()
        release_memory()

    made = ranged.mapInArrow(shards, MANIFEST)
    made.write.parquet(f"{folder}/manifest")
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row a shard: this window sees the manifest only.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Read the listed shards back: one row per document (doc_id, start,
    n_tokens, ids_crc32), decoded from the files alone."""
    spark = manifest.sparkSession
    ship_package(spark)

    def decode(batches):
        import pyarrow as pa
        fs, path = task_fs(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_stream(f"{path}/{name}") as f:
                    shard = Shard(f.read())
                ids = shard.slice(0, shard.n_tokens)
                b = shard.bound
                crc = [zlib.crc32(ids[x:y].tobytes()) for x, y in zip(b[:-1].tolist(), b[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids(), pa.int64()), pa.array(b[:-1] + start),
                     pa.array(np.diff(b)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
                del shard, ids
        release_memory()

    # A stated number of partitions: one by size would put small rows, and so
    # all the files that they name, in one task.
    spread = manifest.select("file", "start").repartition(shuffle_partitions(spark), "file")
    return spread.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenise(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write ``docs`` as token shards in the shared folder and read them back."""
    folder = scratch_dir(docs.sparkSession, "tokens")
    return read_documents(write_tokens(docs, tokenizer_path, folder, **options), folder)
