"""The registered queries of this package: ``QUERIES`` (name -> function of
(spark, sf_dir)) and ``ORACLE_SQL`` (name -> DuckDB SQL where there is one)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ 1

@query("op1_simhash_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import hex_fingerprint, simhash_groups
    g = simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_distance=4)
    return g.select(F.col("id").alias("doc_id"), hex_fingerprint("fp").alias("fingerprint"), "component_id")


# ------------------------------------------------------------------ 4

def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(host, bad) of the pages whose document is labelled: the number at the
    end of a page's path names its document; bad is low quality or toxic."""
    from .urlfilter import url_host, url_path
    number = F.regexp_extract(url_path("url"), r"/(\d{1,18})(?:\.html|/)?$", 1)
    pages = table(spark, sf_dir, "pages").select(url_host("url").alias("host"), number.alias("n"))
    pages = pages.where("n <> ''").select("host", F.col("n").cast("long").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int").alias("bad"))
    return pages.join(labels, "doc_id").select("host", "bad")


# The same rules, the same three levels of shrinkage, and for hosts without
# labels the priors of their domain, suffix and the root; a host's number is
# compared with the threshold only, so rounding does not show.
OP4_SQL = r"""
WITH u AS (
  SELECT page_id, url, lower_az.host, lower_az.path FROM (
    SELECT page_id, url,
      struct_pack(host := translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  path := regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's')) AS lower_az
    FROM pages)),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT u.page_id, u.url, arg_max(struct_pack(rule := rhost || rpath, verdict := verdict), length(rhost || rpath)) AS hit
  FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY u.page_id, u.url),
outcomes AS (
  SELECT host, CASE WHEN quality = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END AS bad
  FROM u JOIN labels ON labels.doc_id = TRY_CAST(nullif(regexp_extract(path, '/(\d{1,18})(?:\.html|/)?$', 1), '') AS BIGINT)
  WHERE quality IS NOT NULL OR coalesce(toxic, 0) = 1),
hosts AS (
  SELECT host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
    list_extract(string_split(host, '.'), -1) AS sfx, count(*) AS n, sum(bad) AS bad FROM outcomes GROUP BY ALL),
domains AS (SELECT domain, sfx, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
sfxs AS (SELECT sfx, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
total AS (SELECT sum(bad) / sum(n) AS m FROM sfxs),
st0 AS (SELECT sum(bad) / sum(n) AS m, greatest(sum(bad * bad / n) / sum(n) - (sum(bad) / sum(n)) ** 2, 0) AS v, count(*) AS k FROM sfxs),
s0 AS (SELECT CASE WHEN k < 2 OR v <= 0 OR m <= 0 OR m >= 1 THEN 1000 ELSE least(greatest(m * (1 - m) / v - 1, 1), 1000) END AS s FROM st0),
p1 AS (SELECT sfx, (bad + s * m) / (n + s) AS m FROM sfxs, s0, total),
st1 AS (SELECT sfx, sum(bad) / sum(n) AS m, greatest(sum(bad * bad / n) / sum(n) - (sum(bad) / sum(n)) ** 2, 0) AS v, count(*) AS k FROM domains GROUP BY sfx),
s1 AS (SELECT sfx, CASE WHEN k < 2 OR v <= 0 OR m <= 0 OR m >= 1 THEN 1000 ELSE least(greatest(m * (1 - m) / v - 1, 1), 1000) END AS s FROM st1),
p2 AS (SELECT domain, (bad + s * m) / (n + s) AS m FROM domains JOIN s1 USING (sfx) JOIN p1 USING (sfx)),
st2 AS (SELECT domain, sum(bad) / sum(n) AS m, greatest(sum(bad * bad / n) / sum(n) - (sum(bad) / sum(n)) ** 2, 0) AS v, count(*) AS k FROM hosts GROUP BY domain),
s2 AS (SELECT domain, CASE WHEN k < 2 OR v <= 0 OR m <= 0 OR m >= 1 THEN 1000 ELSE least(greatest(m * (1 - m) / v - 1, 1), 1000) END AS s FROM st2),
ab AS (
  SELECT 'host' AS level, host AS key, bad + s * m AS a, n - bad + s * (1 - m) AS b FROM hosts JOIN s2 USING (domain) JOIN p2 USING (domain)
  UNION ALL SELECT 'domain', domain, s * m, s * (1 - m) FROM s2 JOIN p2 USING (domain)
  UNION ALL SELECT 'sfx', sfx, s * m, s * (1 - m) FROM s1 JOIN p1 USING (sfx)
  UNION ALL SELECT 'root', '', s * m, s * (1 - m) FROM s0, total),
rep AS (SELECT level, key, greatest(a / (a + b) - 1.645 * sqrt(a * b / ((a + b) ** 2 * (a + b + 1))), 0) AS bound FROM ab)
SELECT u.page_id, u.host, u.path, hit.rule AS rule,
  coalesce(hit.verdict, CASE WHEN coalesce(h.bound, d.bound, s.bound, r.bound) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fits ON fits.page_id = u.page_id AND fits.url IS NOT DISTINCT FROM u.url
LEFT JOIN rep h ON h.level = 'host' AND h.key = u.host
LEFT JOIN rep d ON d.level = 'domain' AND d.key = array_to_string(list_slice(string_split(u.host, '.'), -2, -1), '.')
LEFT JOIN rep s ON s.level = 'sfx' AND s.key = list_extract(string_split(u.host, '.'), -1)
LEFT JOIN rep r ON r.level = 'root'
"""


@query("op4_url_filter", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urlfilter import filter_urls
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, page_outcomes(spark, sf_dir)).select("page_id", "host", "path", "rule", "verdict")


# ------------------------------------------------------------------ 5

def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_token_output")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokens import tokenise
    return tokenise(table(spark, sf_dir, "documents"), tokenizer_path=tokenizer_path(), end_id=2)


# ------------------------------------------------------------------ 9

@query("op9_warc")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_and_read
    r = archive_and_read(table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return r.select(F.col("record_id").cast("long").alias("page_id"), F.col("length").alias("payload_bytes"),
                    F.col("digest").alias("payload_digest"), "record_type", F.col("refers_to").cast("long").alias("refers_to"))


# ------------------------------------------------------------------ 8

@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# ------------------------------------------------------------------ 2

@query("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import find_contamination
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# ------------------------------------------------------------------ 3

@query("op3_source_mixing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mix import mix_sources
    m = mix_sources(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "source", "mix_slot", "mix_epoch", "mix_block", "mix_offset")


# ------------------------------------------------------------------ 10

@query("op10_repeated_substrings")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix import remove_repeats
    r = remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return r.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


# ------------------------------------------------------------------ 6

def language_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (text only) and pages (markup, address) as rows to identify."""
    from .langid import declared_language
    from .urlfilter import url_host
    none = F.lit(None).cast("string")
    docs = table(spark, sf_dir, "documents").select(
        F.struct(F.col("doc_id"), F.lit(None).cast("long").alias("page_id")).alias("id"),
        F.col("text").cast("binary").alias("body"), F.lit(False).alias("is_markup"), none.alias("declared"), none.alias("host"))
    pages = table(spark, sf_dir, "pages").select(
        F.struct(F.lit(None).cast("long").alias("doc_id"), F.col("page_id")).alias("id"),
        F.col("html").cast("binary").alias("body"), F.lit(True).alias("is_markup"),
        declared_language("html").alias("declared"), url_host("url").alias("host"))
    return docs.unionByName(pages)


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify, train
    model = train(table(spark, sf_dir, "documents"))
    r = identify(language_rows(spark, sf_dir), model)
    return r.select("id.doc_id", "id.page_id", "lang", "probability", "text_lang")


# ------------------------------------------------------------------ 7

TOOLS = {"answer": {"question": {"type": "string", "required": True, "max_length": 300},
                    "turn": {"type": "integer", "required": True, "minimum": 0},
                    "words": {"type": "integer", "minimum": 5}}}


def tool_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The conversations as tool traffic: a user turn calls ``answer``, using the
    result of the turn two before; any other turn is a result for the turn
    before it."""
    t = table(spark, sf_dir, "conversations")

    def call_id(turn):
        return F.concat_ws("-", F.lit("call"), "conv_id", turn)

    turn = F.col("turn")
    words = F.size(F.filter(F.split(F.col("text"), " "), lambda w: w != ""))
    calls = t.where("role = 'user'").select(
        "conv_id", call_id(turn).alias("call_id"), call_id(turn - 2).alias("after"), "turn", F.lit("answer").alias("name"),
        F.to_json(F.struct(words.alias("words"), turn.alias("turn"), F.col("text").alias("question"))).alias("arguments"))
    results = t.where("role <> 'user'").select("conv_id", call_id(turn - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


OP7_SQL = r"""
WITH t AS (SELECT conv_id, turn, role, text, 'call-' || conv_id || '-' AS stem,
             len(list_filter(string_split(text, ' '), lambda w: w <> '')) AS words FROM conversations),
calls AS (SELECT *, lag(turn) OVER w AS before, row_number() OVER w AS k FROM t WHERE role = 'user'
          WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
chains AS (SELECT *, sum(CASE WHEN before = turn - 2 THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain
           FROM (SELECT * REPLACE (lag(turn) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS before) FROM calls)),
deep AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, chain ORDER BY turn) - 1 AS depth FROM chains),
linked AS (
  SELECT c.conv_id, c.stem || c.turn AS call_id, c.turn, c.depth,
    CASE WHEN r.turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status, r.turn AS result_turn,
    list_sort(list_filter([CASE WHEN length(c.text) > 300 THEN 'question: length' END, CASE WHEN c.turn < 0 THEN 'turn: minimum' END,
      CASE WHEN c.words < 5 THEN 'words: minimum' END], lambda e: e IS NOT NULL)) AS errors,
    '{"after":"' || c.stem || (c.turn - 2) || '","arguments":{"question":' || to_json(c.text) || ',"turn":' || c.turn
      || ',"words":' || c.words || '},"call_id":"' || c.stem || c.turn || '"'
      || CASE WHEN r.turn IS NULL THEN '' ELSE ',"content":' || to_json(r.text) END || ',"conv_id":' || c.conv_id AS head,
    ',"name":"answer","status":"' || CASE WHEN r.turn IS NULL THEN 'unanswered' ELSE 'linked' END || '"}' AS tail
  FROM deep c LEFT JOIN t r ON r.conv_id = c.conv_id AND r.turn = c.turn + 1 AND r.role <> 'user'),
orphans AS (
  SELECT r.conv_id, r.stem || (r.turn - 1) AS call_id, r.turn, NULL::BIGINT AS depth, 'orphan' AS status, r.turn AS result_turn,
    []::VARCHAR[] AS errors,
    '{"call_id":"' || r.stem || (r.turn - 1) || '","content":' || to_json(r.text) || ',"conv_id":' || r.conv_id || ',"status":"orphan"}' AS json
  FROM t r WHERE r.role <> 'user' AND NOT EXISTS (
    SELECT 1 FROM t c WHERE c.conv_id = r.conv_id AND c.turn = r.turn - 1 AND c.role = 'user'))
SELECT conv_id, call_id, turn, depth, status, result_turn, array_to_string(errors, '|') AS errors,
  head || CASE WHEN len(errors) = 0 THEN '' ELSE ',"errors":' || to_json(errors) END || tail AS json FROM linked
UNION ALL SELECT conv_id, call_id, turn, depth, status, result_turn, array_to_string(errors, '|'), json FROM orphans
"""


@query("op7_chat_tools", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import link_tool_calls
    calls, results = tool_events(spark, sf_dir)
    return link_tool_calls(calls, results, TOOLS).withColumn("errors", F.array_join("errors", "|"))


# ------------------------------------------------------------------ 11

def _letters(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _spans_sql(kind: str, place: int, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT rid, '{kind}' AS kind, {place} AS place, {least} AS least, regexp_extract_all(text, '{p}', 0) AS found,
  regexp_extract_all(text, '{p}', {group}) AS held, string_split_regex(text, '{p}') AS gaps FROM d"""


def _op11_sql() -> str:
    from .secret_scan import EXTRA
    word = "|".join(map(_letters, ("password", "passwd", "secret", "token", "api_?key")))
    found = [_spans_sql("assign", 0, f"({word})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
             _spans_sql("access", 1, "AKIA[A-Z0-9]+", 0, 20), _spans_sql("hex", 2, "[0-9a-f]+", 0, 24)]
    found += [_spans_sql(r.kind, place, r.pattern, 0, 0) for place, r in enumerate(EXTRA, 3)]
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(found)}),
e AS (SELECT rid, kind, place, least, unnest(found) AS f, unnest(held) AS h, unnest(gaps[1:len(found)]) AS gap,
  unnest(range(1, len(found) + 1)) AS i FROM m WHERE len(found) > 0),
s AS (SELECT rid, kind, place, sum(length(gap) + length(f)) OVER (PARTITION BY rid, place ORDER BY i) AS e, length(f) AS n, length(h) >= least AS ok FROM e),
k AS (SELECT rid, kind, place, e - n AS b, kind || ':' || (e - n)::BIGINT || ':' || e::BIGINT AS span FROM s WHERE ok),
g AS (SELECT rid, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
  string_agg(span, ',' ORDER BY b, place) FILTER (place < 3) AS base, string_agg(span, ',' ORDER BY b, place) AS spans FROM k GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (rid)
"""


@query("op11_secret_scan", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import BASE, RULES, kinds, scan

    def count(place):
        return F.size(F.filter("spans", lambda s: s["place"] == place)).cast("long")

    s = scan(table(spark, sf_dir, "documents"))
    return s.select(F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                    F.sha2(kinds(F.col("spans"), RULES, len(BASE)), 256).alias("base_sha256"),
                    kinds(F.col("spans"), RULES).alias("spans"))


# ------------------------------------------------------------------ 12

def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of one document in ten, chosen by the checksum of its id,
    the words from a place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    chosen = docs.select("doc_id", "text", h.alias("h"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    cut = (chosen.where("h % 10 = 0").select("doc_id", "text", "h", words.alias("words"))
           .withColumn("a", F.when(n > 0, g % n).cast("int"))
           .withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int")))
    a, p = F.col("a"), F.col("p")
    place = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    planted = F.array_join(F.transform(place, lambda i: F.element_at(
        "words", F.when(i < a, i).otherwise(a + (i - a) % p) + 1)), " ")
    return (cut.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))
            .unionByName(chosen.where("h % 10 <> 0 OR h IS NULL").select("doc_id", "text")))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic import find_runs, strongest
    r = find_runs(with_planted_runs(table(spark, sf_dir, "documents")), min_length=6, min_exponent=4)
    r = r.withColumn("best", strongest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda x: F.concat(
        F.concat_ws(",", *[x[f].cast("string") for f in ("start", "length", "period")]), F.lit("\n"))), "")
    return r.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


# ------------------------------------------------------------------ 13

OP13_SQL = r"""
WITH bits AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, b::BIGINT)) AS t),
words AS MATERIALIZED (
  SELECT 0 AS side, row_number() OVER () AS rid, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL SELECT 1, 0, NULL, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
seen AS (SELECT w, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(w), 2 * i + 1, 2))::BIGINT) AS bytes
  FROM (SELECT DISTINCT w FROM words)),
buckets AS MATERIALIZED (SELECT w, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS b
  FROM seen, bits),
counts AS (SELECT b, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM words JOIN buckets USING (w) GROUP BY b),
gains AS (SELECT b, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
  FROM counts, (SELECT sum(s)::DOUBLE AS all_s, sum(t)::DOUBLE AS all_t FROM counts)),
sums AS (SELECT rid, count(*) AS n, sum(gain)::BIGINT AS weight FROM words JOIN buckets USING (w) JOIN gains USING (b) WHERE side = 0 GROUP BY rid),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) LEFT JOIN sums USING (rid)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed
"""


@query("op13_importance_resampling", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resample import resample
    r = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), max_n=1, buckets=10_000, percent=10,
                 min_words=20, seed="2024")
    return r.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
