"""WARC archives: writing with revisit records, and split reading by
boundary-chain verification.

Reading.  An archive is cut into byte splits and every split is one task.  A
task cannot know where the first record of its split starts: the record magic
(``WARC/1.`` or, with a gzip member a record, the gzip magic) may also stand
inside a payload.  So it takes every place with the magic as a candidate, works
out where a record that starts there would end (its successor), and follows
successors inside the split to the first offset beyond it.  That gives rows
(file, candidate, exit).  From the file start, pointer jumping over this table
marks the candidates that are reached: each round joins the table with itself
and doubles the jump, so a file of ``n`` splits needs about log2(n) rounds.
Only then are the splits parsed, each from its one reached entry; candidates
inside payloads are never reached, whatever they look like.

Writing.  Records with equal payloads (by digest) of at least a minimum length
share one response, that of the largest id; the others become revisit records
without a body.  Equal payloads are found on digests alone, summed before the
shuffle.  Tasks write archives under names no other attempt uses and report
them as rows; the table of reported files is the archive."""

from __future__ import annotations

import base64
import re
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_dir, ship_package, shuffle_partitions, task_fs, written

PLAIN_MAGIC, GZIP_MAGIC = b"WARC/1.", b"\x1f\x8b\x08"
SPLIT_BYTES = 32 << 20
FILE_BYTES = 256 << 20
GZIP_LEVEL = 4
_READ = 1 << 20
_TAIL = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "file string, n_bytes long"


# ---------------------------------------------------------------- records

def base32_of_hex(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def record_bytes(record_id: str, url: str | None, payload: bytes | None, digest: str, length: int,
                 refers_to: str | None, level: int | None) -> bytes:
    """One record; ``payload`` None makes a revisit of ``refers_to``.  ``level``
    None: plain, else a gzip member of its own."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = ["WARC/1.1", "WARC-Type: " + ("response" if refers_to is None else "revisit"),
            f"WARC-Record-ID: <urn:x-page:{record_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
            "Content-Type: text/html; charset=utf-8", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Payload-Length: {length}"]
    if uri:
        head.append(f"WARC-Target-URI: {uri}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    body = payload or b""
    raw = "\r\n".join([*head, f"Content-Length: {len(body)}", "", ""]).encode("utf-8") + body + _TAIL
    if level is None:
        return raw
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


class BadRecord(ValueError):
    pass


def _headers(block: bytes) -> dict[str, str]:
    lines = block.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.\d", lines[0]):
        raise BadRecord("no version line")
    out = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise BadRecord("header without a colon")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """(headers, body, length) of the plain record at the start of ``raw``."""
    end = raw.find(_TAIL)
    if end < 0:
        raise BadRecord("headers do not end")
    head = _headers(raw[:end])
    if not re.fullmatch(r"\d{1,18}", head.get("content-length", "")):
        raise BadRecord("no length")
    a = end + 4
    b = a + int(head["content-length"])
    if raw[b:b + 4] != _TAIL:
        raise BadRecord("record does not end after its length")
    return head, raw[a:b], b + 4


class Window:
    """A file's bytes from ``start`` on, read in steps as they are asked for
    (records may run beyond the split they start in)."""

    def __init__(self, f, start: int, size: int):
        self.f, self.start, self.size = f, start, size
        self.data = bytearray()
        f.seek(start)

    def upto(self, end: int) -> None:
        end = min(end, self.size)
        while self.start + len(self.data) < end:
            got = self.f.read(max(_READ, end - self.start - len(self.data)))
            if not got:
                break
            self.data += got

    def record(self, at: int, gz: bool, keep: bool = True) -> tuple[dict[str, str], bytes, int]:
        """(headers, body, successor) of the record at file offset ``at``."""
        return self._gzip(at) if gz else self._plain(at, keep)

    def _gzip(self, at: int):
        z, raw, pos = zlib.decompressobj(31), [], at
        while not z.eof:
            self.upto(pos + 1)
            piece = bytes(self.data[pos - self.start:pos - self.start + _READ])
            if not piece:
                raise BadRecord("member does not end")
            try:
                raw.append(z.decompress(piece))
            except zlib.error as e:
                raise BadRecord(str(e)) from e
            if not raw[0].startswith(PLAIN_MAGIC[:len(raw[0])]):
                raise BadRecord("no version line")
            pos += len(piece) - len(z.unused_data)
        head, body, n = parse_record(b"".join(raw))
        if n != sum(map(len, raw)):
            raise BadRecord("more than one record in a member")
        return head, body, pos

    def _plain(self, at: int, keep: bool):
        o = at - self.start
        want = at + 4096
        while True:
            self.upto(want)
            end = self.data.find(_TAIL, o)
            if end >= 0:
                break
            if self.start + len(self.data) >= self.size or want - at > 1 << 20:
                raise BadRecord("headers do not end")
            want += 1 << 16
        head = _headers(bytes(self.data[o:end]))
        if not re.fullmatch(r"\d{1,18}", head.get("content-length", "")):
            raise BadRecord("no length")
        a = end + 4
        b = a + int(head["content-length"])
        if self.start + b + 4 > self.size:
            raise BadRecord("record runs beyond the file")
        self.upto(self.start + b + 4)
        if self.data[b:b + 4] != _TAIL:
            raise BadRecord("record does not end after its length")
        return head, bytes(self.data[a:b]) if keep else b"", self.start + b + 4


def split_chain(f, start: int, end: int, size: int, gz: bool) -> list[tuple[int, int]]:
    """(candidate, exit) for every place of [start, end) where a whole record
    can be read; ``exit`` is the first offset at or beyond ``end`` that its chain
    of successors reaches, -1 if the chain breaks inside the split."""
    magic = GZIP_MAGIC if gz else PLAIN_MAGIC
    w = Window(f, start, size)
    w.upto(end + len(magic) - 1)
    succ, at = {}, w.data.find(magic)
    while 0 <= at < end - start:
        try:
            succ[start + at] = w.record(start + at, gz, keep=False)[2]
        except BadRecord:
            pass
        at = w.data.find(magic, at + 1)
    out: dict[int, int] = {}
    for c in sorted(succ, reverse=True):  # successors lie behind, so one pass suffices
        s = succ[c]
        out[c] = s if s >= end else out.get(s, -1)
    return sorted(out.items())


# ---------------------------------------------------------------- Spark jobs

def write_archives(records: DataFrame, folder: str, compress: bool = True, file_bytes: int = FILE_BYTES,
                   min_revisit_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``records`` (id, url, payload binary; more
    columns are not read) under ``folder``; returns the files (file, n_bytes).

    Null payloads are empty.  Equal payloads of at least ``min_revisit_bytes``
    become revisits of the one with the largest id (null ids count as smaller
    than any other; rows that repeat that id are all responses)."""
    spark = records.sparkSession
    ship_package(spark)
    level = GZIP_LEVEL if compress else None

    def prepare(batches):
        # The record as a response, made before the shuffle so that it is
        # shuffled compressed; the row's group then decides if it is kept.
        import pyarrow as pa
        for batch in batches:
            ids, urls, shas = (batch.column(c).to_pylist() for c in range(3))
            raws, lengths = [], []
            for i, u, s, p in zip(ids, urls, shas, batch.column(3)):
                p = p.as_py()
                lengths.append(len(p))
                raws.append(record_bytes(str(i), u, p, base32_of_hex(s), len(p), None, level))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(shas, pa.string()),
                 pa.array(lengths, pa.int64()), pa.array(raws, pa.binary())], names=["id", "url", "sha", "length", "raw"])

    body = F.coalesce("payload", F.lit(b""))
    r = records.select(F.col("id").cast("long"), "url", F.sha1(body).alias("sha"), body.alias("payload"))
    made = r.mapInArrow(prepare, "id long, url string, sha string, length long, raw binary")
    top = (r.where(F.length("payload") >= min_revisit_bytes).groupBy("sha").agg(F.max("id").alias("top")))
    j = made.join(top, "sha", "left").select("id", "url", "sha", "length", "raw", "top")

    def archives(batches):
        import pyarrow as pa
        fs, path = task_fs(folder)
        out, name, size, suffix = None, "", 0, ".warc.gz" if compress else ".warc"

        def row():
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size])], names=["file", "n_bytes"])

        for batch in batches:
            for i, u, sha, n, raw, top_id in zip(*(batch.column(c).to_pylist() for c in range(6))):
                if n >= min_revisit_bytes and top_id is not None and i != top_id:
                    raw = record_bytes(str(i), u, None, base32_of_hex(sha), n, str(top_id), level)
                if out is None:
                    fs.create_dir(path, recursive=True)
                    name, size = f"{uuid.uuid4().hex}{suffix}", 0
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                out.write(raw)
                size += len(raw)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield row()
        if out is not None:
            out.close()
            yield row()

    return written(j.mapInArrow(archives, FILES), "warc-files")



def verified_entries(files: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(file, n_bytes, split, entry): the first record of every split that
    holds one, found by pointer jumping from each file's start.

    Raises if a chain breaks before the end of its file (a damaged archive)."""
    spark = files.sparkSession
    ship_package(spark)
    splits = files.select("file", "n_bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.ceil(F.col("n_bytes") / split_bytes) - 1)).alias("split")).where("n_bytes > 0")

    def candidates(batches):
        import pyarrow as pa
        fs, path = task_fs(folder)
        for batch in batches:
            for name, size, split in zip(*(batch.column(c).to_pylist() for c in range(3))):
                with fs.open_input_file(f"{path}/{name}") as f:
                    found = split_chain(f, split * split_bytes, min(size, (split + 1) * split_bytes), size,
                                        name.endswith(".gz"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array([size] * len(found), pa.int64()),
                     pa.array([c for c, _ in found], pa.int64()), pa.array([e for _, e in found], pa.int64())],
                    names=["file", "n_bytes", "at", "exit"])

    # Keyed by file and split, so the splits of a file spread over the tasks;
    # in a stated number of partitions, as these small rows name large inputs.
    c = written(splits.repartition(shuffle_partitions(spark), "file", "split").mapInArrow(
        candidates, "file string, n_bytes long, at long, exit long"), "warc-candidates")
    # Only the file start and places where a chain enters a split can be entries.
    entered = c.where("exit >= 0").select("file", F.col("exit").alias("at")).distinct()
    jump = written(c.where("at = 0").unionByName(c.where("at > 0").join(entered, ["file", "at"], "left_semi"))
                   .select("file", "n_bytes", "at", "exit"), "warc-jumps")
    reached = jump.where("at = 0").select("file", "n_bytes", "at", "exit")
    table, known = jump.select("file", F.col("at").alias("src"), F.col("exit").alias("dst")), reached.count()
    while True:
        # Whatever a reached entry jumps to is reached; then the jumps double.
        step = reached.select("file", "at").join(table.withColumnRenamed("src", "at"), ["file", "at"]).select(
            "file", F.col("dst").alias("at"))
        more = step.join(jump, ["file", "at"]).select("file", "n_bytes", "at", "exit")
        reached = written(reached.unionByName(more).distinct(), "warc-reached")
        now = reached.count()
        if now == known:
            break
        known = now
        nxt = table.select("file", F.col("src").alias("dst"), F.col("dst").alias("_far"))
        table = written(table.join(nxt, ["file", "dst"], "left").select(
            "file", "src", F.coalesce("_far", "dst").alias("dst")), "warc-jumps")
    ends = files.where("n_bytes > 0").join(
        reached.where("exit = n_bytes").select("file").distinct(), "file", "left_anti")
    broken = [x["file"] for x in ends.limit(5).collect()]
    if broken:
        raise ValueError(f"the record chain of {broken} breaks before the end of the file")
    return reached.select("file", "n_bytes", F.floor(F.col("at") / split_bytes).alias("split"), F.col("at").alias("entry"))


def read_archives(files: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per record of the listed archives: (file, at, record_id,
    record_type, url, digest, length, refers_to, body)."""
    entries = verified_entries(files, folder, split_bytes)
    schema = ("file string, at long, record_id string, record_type string, url string, digest string, "
              "length long, refers_to string, body binary")

    def records(batches):
        import pyarrow as pa
        fs, path = task_fs(folder)
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in schema.split(", ")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for name, size, split, at in zip(*(batch.column(c).to_pylist() for c in range(4))):
                rows, held, end = [], 0, min(size, (split + 1) * split_bytes)
                with fs.open_input_file(f"{path}/{name}") as f:
                    w = Window(f, at, size)
                    while at < end:
                        head, body, nxt = w.record(at, name.endswith(".gz"))
                        ref = head.get("warc-refers-to")
                        rows.append((name, at, _urn(head["warc-record-id"]), head["warc-type"],
                                     head.get("warc-target-uri"), head["warc-payload-digest"].removeprefix("sha1:"),
                                     int(head["x-payload-length"]), ref and _urn(ref), body))
                        held, at = held + len(body), nxt
                        if held > 1 << 23:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return entries.repartition(shuffle_partitions(files.sparkSession), "file", "split").mapInArrow(records, schema)


def _urn(value: str) -> str:
    return value.removeprefix("<urn:x-page:").removesuffix(">")


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                     compress: bool = True, split_bytes: int = SPLIT_BYTES, **options) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back.
    A null html is an empty payload, a null url leaves out the target address."""
    folder = scratch_dir(pages.sparkSession, "warc")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("binary").alias("payload"))
    return read_archives(write_archives(rows, folder, compress=compress, **options), folder, split_bytes)
