"""Source and sink queries (S1-S3, S5-S7, S11): everything is staged from
the warehouse tables into the session's checkpoint folder, read back
through the operator under test, and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources import files as fl
from ..sources.tables import table
from .credit import CREDIT_FEATURES_SQL, credit_features
from .registry import register


def _dir(spark, name):
    return scratch_path(spark, f"io/{name}_{uuid.uuid4().hex[:10]}")


DOC_SCHEMA = "doc_id long, lang string, source string, n_chars long, text string"


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")


# GBK has no accented Latin letters; a letter that it has stands for them.
GBK_LETTER = "增"


@register("src_csv_encoding", f"""SELECT doc_id, lang, source, n_chars,
  CASE WHEN lang IN ('en', 'de') THEN text ELSE regexp_replace(text, '[^\x01-\x7F]', '{GBK_LETTER}', 'g') END AS text FROM documents""")
def src_csv_encoding(spark, sf_dir):
    """Documents written as CSV in two landing folders, one of them in
    GBK, read back with per-file encoding detection; whole texts,
    multi-line fields."""
    base = _dir(spark, "csv_enc") + ".csv"
    d = _docs(spark, sf_dir)
    fl.write_csv(d.where(F.col("lang").isin("en", "de")), f"{base}/a")
    gbk = d.where(~F.col("lang").isin("en", "de")).withColumn("text", F.regexp_replace("text", r"[^\x01-\x7F]", GBK_LETTER))
    fl.write_csv(gbk, f"{base}/b")
    as_gbk = fl.transcode(spark, fl.detect_encodings(spark, f"{base}/b"), "gbk")
    folders = [f"{base}/a", *{p.rsplit("/", 1)[0] for p in as_gbk}]
    out = [fl.load_csv(spark, p, schema=DOC_SCHEMA) for p in folders]
    return out[0].unionByName(out[1]) if len(out) > 1 else out[0]


def _json_pages(spark, sf_dir, path):
    """Pages of 100 documents: even pages an array a line, odd pages
    pretty-printed, a file each."""
    d = _docs(spark, sf_dir).withColumn("_page", F.floor(F.col("doc_id") / 100))
    fl.write_json_arrays(d.where("_page % 2 = 0"), f"{path}/lines", "_page")
    rows = F.collect_list(F.struct("doc_id", "lang", "source", "n_chars", "text"))
    pretty = d.where("_page % 2 = 1").groupBy("_page").agg(F.to_json(rows, {"pretty": "true"}).alias("value"))
    pretty.select("value").write.option("maxRecordsPerFile", 1).text(f"{path}/pretty")


@register("src_json_records", "SELECT doc_id, lang, source, n_chars, text FROM documents")
def src_json_records(spark, sf_dir):
    """JSON arrays of records, some a line each, some pretty-printed."""
    path = _dir(spark, "json_rec")
    _json_pages(spark, sf_dir, path)
    return fl.load_json(spark, f"{path}/*", DOC_SCHEMA)


@register("src_auto_load", " UNION ALL ".join(
    f"SELECT '{f}' AS format, count(*) AS rows, sum(n_chars)::BIGINT AS chars FROM documents" for f in ("parquet", "csv", "json")))
def src_auto_load(spark, sf_dir):
    """S3: the same documents through the suffix dispatcher (parquet, csv,
    json); rows per format."""
    csv_p = _dir(spark, "auto") + ".csv"
    json_p = _dir(spark, "auto") + ".json"
    d = _docs(spark, sf_dir)
    fl.write_csv(d, csv_p)
    fl.write_json_arrays(d.withColumn("_page", F.floor(F.col("doc_id") / 100)), json_p, "_page")
    parts = []
    for fmt, p in (("parquet", f"{sf_dir}/documents.parquet"), ("csv", csv_p), ("json", json_p)):
        kw = {} if fmt == "parquet" else {"schema": DOC_SCHEMA}
        parts.append(fl.auto_load(spark, p, **kw).select(F.lit(fmt).alias("format"), "doc_id", "n_chars"))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("format").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_chars").alias("chars"))


CREDIT_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("age", T.IntegerType()),
    T.StructField("annual_income", T.DoubleType()), T.StructField("gender_code", T.IntegerType()),
    T.StructField("education_code", T.IntegerType()), T.StructField("credit_history_length", T.DoubleType()),
    T.StructField("total_overdue", T.IntegerType()), T.StructField("num_overdue_90d", T.IntegerType()),
    T.StructField("debt_income_ratio", T.DoubleType()), T.StructField("payment_income_ratio", T.DoubleType()),
    T.StructField("credit_card_utilization", T.DoubleType()), T.StructField("has_mortgage", T.IntegerType()),
    T.StructField("num_credit_cards", T.IntegerType()), T.StructField("num_dependents", T.IntegerType()),
    T.StructField("num_loans", T.IntegerType()), T.StructField("has_overdue", T.IntegerType()),
    T.StructField("severe_overdue", T.IntegerType()), T.StructField("risk_score", T.DoubleType()),
    T.StructField("default_label", T.IntegerType())])


@register("sink_csv_roundtrip", CREDIT_FEATURES_SQL)
def sink_csv_roundtrip(spark, sf_dir):
    """The credit feature table written as CSV with header and read
    back with its schema."""
    path = _dir(spark, "credit_csv")
    fl.write_csv(credit_features(spark, sf_dir), path)
    return spark.read.option("header", True).schema(CREDIT_SCHEMA).csv(path)


def news_rows(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"),
                    F.col("text").alias("content"), F.col("source"),
                    F.concat(F.lit("https://"), F.col("source"), F.lit(".example/doc/"), F.col("doc_id").cast("string"))
                    .alias("url"),
                    F.lit(None).cast("string").alias("publish_time"), F.col("lang").alias("category"),
                    F.array(F.col("lang"), F.col("source")).alias("tags"))


NEWS_SQL = """SELECT 'doc ' || CAST(doc_id AS VARCHAR) AS title, source,
  'https://' || source || '.example/doc/' || CAST(doc_id AS VARCHAR) AS url, lang AS category,
  lang || '|' || source AS tags, CAST(n_chars AS BIGINT) AS json_chars FROM documents"""


@register("sink_news_formats", NEWS_SQL)
def sink_news_formats(spark, sf_dir):
    """News rows saved as JSON, CSV (tags joined by '|') and text; the
    CSV is read back and joined with the JSON copy (whole texts survive)."""
    base = _dir(spark, "news")
    n = news_rows(spark, sf_dir)
    fl.save_news(n, f"{base}/json", "json")
    fl.save_news(n, f"{base}/csv", "csv")
    fl.save_news(n, f"{base}/txt", "txt")
    c = spark.read.option("header", True).option("multiLine", True).option("escape", '"') \
        .schema("title string, content string, source string, url string, publish_time string, category string, "
                "tags string").csv(f"{base}/csv")
    j = spark.read.schema("title string, content string").json(f"{base}/json") \
        .select("title", F.length("content").cast("long").alias("json_chars"))
    return c.select("title", "source", "url", "category", "tags").join(j, "title")


@register("src_manifest_md5")
def src_manifest_md5(spark, sf_dir):
    """Manifest (name, size, time, MD5) of staged document files."""
    base = _dir(spark, "manifest")
    stage_files(_docs(spark, sf_dir)).write.mode("overwrite").parquet(base)
    return fl.manifest(spark, base)


STAGED_FILES, STAGED_ROWS = 4, 1 << 14


def stage_files(docs, rows: int = STAGED_ROWS):
    """Documents dealt by source to ``STAGED_FILES`` files, each source in
    further parts where the files would hold more than about ``rows`` rows."""
    parts = max(1, -(-docs.count() // (STAGED_FILES * rows)))
    if parts == 1:
        return docs.repartition(STAGED_FILES, "source")
    return docs.repartition(STAGED_FILES * parts, "source", F.pmod(F.xxhash64("doc_id"), F.lit(STAGED_FILES * parts)))


PAYLOAD_ITEM = T.StructType([T.StructField("title", T.StringType()), T.StructField("url", T.StringType()),
                             T.StructField("content", T.StringType()), T.StructField("digest", T.StringType()),
                             T.StructField("showTime", T.StringType())])
PAYLOAD_SCHEMA = T.StructType([T.StructField("data", T.StructType([
    T.StructField("list", T.ArrayType(PAYLOAD_ITEM))]))])


def v_payload(spark, sf_dir):
    """Documents as API pages of 20 items: ``{"data": {"list": [...]}}``;
    even ids carry ``content``, odd ids only ``digest`` (the key is absent),
    ids ending in 7 have an empty title."""
    d = table(spark, sf_dir, "documents")
    item = F.struct(
        F.when(F.col("doc_id") % 10 == 7, F.lit("")).otherwise(F.concat(F.col("lang"), F.lit(" "), F.col("source"),
                                                                        F.lit(" #"), F.col("doc_id").cast("string")))
        .alias("title"),
        F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("doc_id") % 2 == 0, F.col("text")).alias("content"),
        F.when(F.col("doc_id") % 2 == 1, F.col("text")).alias("digest"),
        F.lit("2024-01-01 00:00:00").alias("showTime"))
    pages = d.groupBy(F.floor(F.col("doc_id") / 20).alias("page")).agg(
        F.collect_list(F.struct(F.col("doc_id"), item.alias("it"))).alias("items"))  # 20 per page
    body = F.struct(F.struct(F.transform(F.array_sort("items"), lambda s: s["it"]).alias("list")).alias("data"))
    return pages.select("page", F.to_json(body).alias("payload"))


@register("json_payload_explode", """SELECT lang || ' ' || source || ' #' || CAST(doc_id AS VARCHAR) AS title,
  'https://news.example/' || CAST(doc_id AS VARCHAR) AS url, text AS content, '2024-01-01 00:00:00' AS publish_time
FROM documents WHERE doc_id % 10 <> 7""")
def json_payload_explode(spark, sf_dir):
    """Parse the payload (``from_json``), explode ``data.list``,
    content falls back to digest only when the key is absent, empty titles
    dropped."""
    p = v_payload(spark, sf_dir)
    items = p.select(F.explode(F.from_json("payload", PAYLOAD_SCHEMA)["data"]["list"]).alias("i"))
    out = items.select(F.col("i.title").alias("title"), F.col("i.url").alias("url"),
                       F.coalesce(F.col("i.content"), F.col("i.digest")).alias("content"),
                       F.col("i.showTime").alias("publish_time"))
    return out.where(F.col("title").isNotNull() & (F.col("title") != ""))
