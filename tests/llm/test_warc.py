"""WARC round trips, boundary chains and planted magic, against plain Python."""

import base64
import hashlib
import io

import pytest

from conftest import SF001
from ledgerlake.llm import queries, warc
from ledgerlake.llm.common import scratch_dir


def brute(rows, least=0):
    """rows: (id, html) -> (id, bytes, digest, type, refers_to)."""
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    top = {}
    for i, h in rows:
        if i is not None:
            top[digest(h)] = max(top.get(digest(h), i), i)
    out = []
    for i, h in rows:
        n, d = len((h or "").encode()), digest(h)
        rev = n >= least and i is not None and top[d] != i
        out.append((i, n, d, "revisit" if rev else "response", top[d] if rev else None))
    return sorted(out, key=repr)


def shape(df):
    return sorted(((int(r.record_id), r.length, r.digest, r.record_type, r.refers_to and int(r.refers_to))
                   for r in df.collect()), key=repr)


def test_query(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op9_warc"](spark, SF001).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)
    assert got == brute(rows)


def trap(n):
    inner = warc.record_bytes(f"{10_000 + n}", "http://x/", b"inner", "A" * 32, 5, None, None).decode()
    return f"WARC/1.0\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n{inner}" * n


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("split", [300, 2000, 1 << 25])
def test_magic_in_payloads_nulls_copies_and_splits(spark, compress, split):
    html = [None, "", "same", "same", "same", "é€😀", "\r\n\r\n", "WARC/1.0\r\n\r\n", trap(1), trap(3), "x" * 70_000, trap(40)]
    html += [trap(2) + str(i) for i in range(20)]
    rows = list(enumerate(html))
    df = spark.createDataFrame([(i, f"http://h/ \n{i}" if i % 3 else None, h, "x", 1) for i, h in rows],
                               "page_id long, url string, html string, raw string, top int").repartition(3)
    out = warc.archive_and_read(df, compress=compress, split_bytes=split, file_bytes=100_000)
    assert shape(out) == brute(rows)
    body = {int(r.record_id): bytes(r.body) for r in out.where("record_type = 'response'").collect()}
    assert all(body[i] == (html[i] or "").encode() for i in body)
    urls = {int(r.record_id): r.url for r in out.collect()}
    assert urls[3] is None and urls[1] == "http://h/%20%0A1"


def test_gzip_magic_inside_gzip_payload():
    inner = warc.record_bytes("1", None, b"p", "A" * 32, 1, None, 0)
    raw = warc.record_bytes("2", None, inner * 3, "A" * 32, len(inner) * 3, None, 0)  # stored, so the magic shows
    raw += warc.record_bytes("3", None, b"q", "A" * 32, 1, None, 4)
    assert raw.count(warc.GZIP_MAGIC) > 2
    chain = dict(warc.split_chain(io.BytesIO(raw), 0, len(raw), len(raw), True))
    assert chain[0] == len(raw)
    half = len(raw) // 2
    first = dict(warc.split_chain(io.BytesIO(raw), 0, half, len(raw), True))
    assert first[0] >= half


def test_minimum_length(spark):
    rows = [(1, "ab"), (2, "ab"), (3, "long enough"), (4, "long enough"), (5, None), (6, "")]
    df = spark.createDataFrame([(i, None, h) for i, h in rows], "page_id long, url string, html string")
    assert shape(warc.archive_and_read(df, min_revisit_bytes=5)) == brute(rows, 5)


def test_damaged_archive_is_reported(spark):
    folder = scratch_dir(spark, "warc-bad")
    fs, path = warc.task_fs(folder)
    fs.create_dir(path, recursive=True)
    good = warc.record_bytes("1", None, b"abc", "A" * 32, 3, None, None)
    with fs.open_output_stream(f"{path}/x.warc") as f:
        f.write(good + b"garbage" + good)
    files = spark.createDataFrame([("x.warc", 2 * len(good) + 7)], warc.FILES)
    with pytest.raises(ValueError, match="breaks"):
        warc.read_archives(files, folder).collect()


def test_empty_table(spark):
    assert warc.archive_and_read(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
