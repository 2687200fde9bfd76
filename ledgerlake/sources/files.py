"""File sources and sinks.

* CSV with per-file encoding detection: files are listed without their
  contents, each one is decoded in chunks by a task until one candidate
  encoding has read it to the end.  Files in UTF-8 go to Spark's CSV reader as
  they are, others (Spark reads no GBK) are first copied to UTF-8, in chunks.
* JSON files of records: an array (or object) per line, or one array over
  many lines; told apart by the first line of the file.
* ``auto_load``: reader registry by suffix.
* Sinks: CSV with header, news rows as JSON / CSV (tags joined by ``|``) /
  formatted text, and a file manifest with size, time and MD5.
"""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Fixed values of the loader: encodings tried after the requested one, in
# order; suffixes the dispatcher knows.
FALLBACK_ENCODINGS = ["utf-8", "gbk", "gb2312", "utf-8-sig"]
SUFFIXES = {".csv": "csv", ".json": "json", ".parquet": "parquet", ".xlsx": "excel", ".xls": "excel"}


def _open(path: str):
    """A file of any storage that pyarrow knows, as a byte stream."""
    import re

    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return store.open_input_stream(name)


def _paths(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """The files under ``path``, a row each (their contents are not read)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(path).select("path")
    return files.repartition(max(1, spark.sparkContext.defaultParallelism), "path")


def first_encoding(chunks, order: list[str]) -> str | None:
    """The first encoding of ``order`` that decodes all chunks to the end."""
    import codecs
    alive, start = {e: codecs.getincrementaldecoder(e)() for e in order}, b""
    for chunk in chunks:
        start = start or bytes(chunk[:3])
        for e in list(alive):
            try:
                alive[e].decode(chunk)
            except UnicodeDecodeError:
                del alive[e]
        if not alive:
            return None
    for e, d in alive.items():
        try:
            d.decode(b"", final=True)
        except UnicodeDecodeError:
            continue
        return "utf-8-sig" if e == "utf-8" and start == b"\xef\xbb\xbf" else e
    return None


def detect_encodings(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """(path, encoding) per file: the requested encoding, then the fallbacks;
    a file no encoding decodes is reported with a null encoding."""
    order = [encoding] + [e for e in FALLBACK_ENCODINGS if e != encoding]
    open_, first = _open, first_encoding

    def detect(it):
        for pdf in it:
            found = []
            for p in pdf["path"]:
                with open_(p) as f:
                    found.append(first(iter(lambda f=f: f.read(1 << 20), b""), order))
            yield pd.DataFrame({"path": pdf["path"], "encoding": found})
    return _paths(spark, path, "*.csv").mapInPandas(detect, "path string, encoding string")


def transcode(spark: SparkSession, paths: DataFrame, to: str = "utf-8") -> list[str]:
    """Copy files (path, encoding) to the encoding ``to`` under the session's
    scratch folder, a file a task and in chunks; the copies of the attempts
    that counted are returned."""
    folder, open_ = scratch_path(spark, f"transcoded/{uuid.uuid4().hex}"), _open

    def copy(it):
        import codecs
        import re

        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))
        store.create_dir(base, recursive=True)
        for pdf in it:
            made = []
            for p, e in zip(pdf["path"], pdf["encoding"]):
                name = f"{uuid.uuid4().hex}-{p.rsplit('/', 1)[-1]}"
                read, write = codecs.getincrementaldecoder(e)(), codecs.getincrementalencoder(to)()
                with open_(p) as src, store.open_output_stream(f"{base}/{name}") as out:
                    for chunk in iter(lambda src=src: src.read(1 << 20), b""):
                        out.write(write.encode(read.decode(chunk)))
                    out.write(write.encode(read.decode(b"", final=True), final=True))
                made.append(name)
            yield pd.DataFrame({"name": made})
    spread = paths.repartition(max(1, spark.sparkContext.defaultParallelism), "path")
    return [f"{folder}/{r['name']}" for r in spread.mapInPandas(copy, "name string").collect()]   # a row per file


def load_csv(spark: SparkSession, path: str, schema=None, encoding: str = "utf-8", **options) -> DataFrame:
    """CSV with header, per-file encoding; raises when a file decodes
    in none of the encodings."""
    enc = detect_encodings(spark, path, encoding).collect()  # one row per file
    bad = [r["path"] for r in enc if r["encoding"] is None]
    if bad:
        raise ValueError(f"no encoding decodes: {bad[:5]}")
    if not enc:
        raise FileNotFoundError(path)
    ready = [r["path"] for r in enc if r["encoding"] == "utf-8"]
    other = [(r["path"], r["encoding"]) for r in enc if r["encoding"] != "utf-8"]
    if other:       # with a byte order mark too, which is dropped on the way
        ready += transcode(spark, spark.createDataFrame(other, "path string, encoding string"))
    rd = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    for k, v in options.items():
        rd = rd.option(k, v)
    return (rd.schema(schema) if schema is not None else rd).csv(ready)


def json_layouts(spark: SparkSession, path: str) -> DataFrame:
    """(path, multi) per file: whether its first line with content is not a
    whole JSON value, so that a value spans lines."""
    open_ = _open

    def look(it):
        import json
        for pdf in it:
            found = []
            for p in pdf["path"]:
                line, rest = b"", True
                with open_(p) as f:
                    while rest and b"\n" not in line.lstrip():
                        rest = f.read(1 << 20)
                        line += rest
                try:
                    json.loads(line.lstrip().split(b"\n", 1)[0] or b"null")
                    found.append(False)
                except ValueError:
                    found.append(True)
            yield pd.DataFrame({"path": pdf["path"], "multi": found})
    return _paths(spark, path).mapInPandas(look, "path string, multi boolean")


def load_json(spark: SparkSession, path: str, schema=None, multi_line: bool | None = None) -> DataFrame:
    """JSON records, one row per record.  Files with one array (or object)
    per line split across tasks; a file with one array over many lines is one
    task.  ``multi_line`` None looks at each file.  Records that do not parse
    raise (``FAILFAST``)."""
    def read(paths, multi):
        rd = spark.read.option("multiLine", multi).option("mode", "FAILFAST")
        return (rd.schema(schema) if schema is not None else rd).json(paths)
    if multi_line is not None:
        return read(path, multi_line)
    kinds: dict[bool, list[str]] = {}
    for r in json_layouts(spark, path).collect():   # a row per file
        kinds.setdefault(r["multi"], []).append(r["path"])
    if not kinds:
        return read(path, False)
    out = None
    for multi, paths in sorted(kinds.items()):
        df = read(paths, multi)
        out = df if out is None else out.unionByName(df, allowMissingColumns=schema is None)
    return out


def auto_load(spark: SparkSession, path: str, **kw) -> DataFrame:
    """S3: dispatch on suffix; unknown suffixes and Excel are errors."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    kind = SUFFIXES.get(suffix)
    if kind == "csv":
        return load_csv(spark, path, **kw)
    if kind == "json":
        return load_json(spark, path, **kw)
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind == "excel":
        raise ValueError("Excel input is not supported (no reader library); convert to CSV or Parquet")
    raise ValueError(f"unsupported file type: {suffix or path}")


def write_json_arrays(df: DataFrame, path: str, page_col: str) -> None:
    """Write each page (a bounded group) as one JSON array of records per
    line."""
    arr = df.groupBy(page_col).agg(F.to_json(F.collect_list(F.struct(*[c for c in df.columns if c != page_col])))
                                   .alias("value"))
    arr.select("value").write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header (a directory of parts)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def save_news(df: DataFrame, path: str, fmt: str = "json") -> str | None:
    """News rows as JSON, CSV (tag list joined by '|') or text blocks."""
    if df.isEmpty():
        return None
    if fmt == "json":
        df.write.mode("overwrite").json(path)
    elif fmt == "csv":
        out = df.withColumn("tags", F.concat_ws("|", "tags")) if "tags" in df.columns else df
        write_csv(out, path)
    elif fmt == "txt":
        block = F.format_string("Title: %s\nSource: %s\nURL: %s\nTime: %s\n%s\n", "title", "source", "url",
                                "publish_time", F.coalesce(F.col("content"), F.lit("")))
        df.select(block.alias("value")).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return path


def manifest(spark: SparkSession, path: str, with_md5: bool = True) -> DataFrame:
    """Key (file name), name, size, modification time and MD5 per file
    (read in chunks by the task that has the file)."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    f = f.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("path"), F.col("length").alias("size"),
                 F.col("modificationTime").alias("modified"))
    if not with_md5:
        return f
    open_ = _open

    @F.pandas_udf("string")
    def md5(paths: pd.Series) -> pd.Series:
        import hashlib
        out = []
        for p in paths:
            h = hashlib.md5()
            with open_(p) as file:
                for chunk in iter(lambda: file.read(1 << 20), b""):
                    h.update(chunk)
            out.append(h.hexdigest())
        return pd.Series(out, dtype="object")

    return f.withColumn("md5", md5("path"))
