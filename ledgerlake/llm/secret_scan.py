"""Secret scans: regular expressions over all texts behind a trigram index.

Every rule's expression gives a Boolean query of trigrams, an OR of ANDs, that
any text with a match must satisfy (``trigram_query``; trigrams of the
lower-cased expression against lower-cased texts, so one index serves rules of
either case).  The inverted index holds a posting (trigram, document) for the
trigrams that some query names.  A clause's postings are intersected by counting
a document's distinct trigrams of the clause; its rules are the document's
candidates.  Candidates and the rules without a mandatory trigram, which scan
every text, are verified with the expressions themselves.

A document is keyed by its id and a 128-bit digest of its text, so null and
repeated ids are told apart and rows that share a key have the same spans.
Candidates are written once; Spark joins them back by broadcast where their
stored size is under its threshold and by a shuffle beyond.  All work is DataFrame functions.
A span's place comes from the lengths of the pieces between the matches, summed
in chunks, so that a text with very many matches costs no square.

Defined cases.  Null and empty texts have no spans.  Expressions are of the
common subset of Java and Python; places are code points, ends exclusive.  The
input's other columns, whatever their names, stay out of the work; ``mask``
returns them all."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SPAN = "struct<start:bigint,place:int,end:bigint>"
CHUNK = 64                # lengths summed together
MAX_STATES = 256          # alternatives that a trigram query follows before it forgets their text


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost first, of which group ``group`` has at
    least ``least`` code points."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0


# The base kinds, then widely published formats of keys.  A run of
# one class of characters that is too short is skipped by either way of writing
# its least length; ``assign`` differs, as a failing match uses up its text.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
EXTRA = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("live_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"[a-z]{2,12}://[A-Za-z0-9._~-]{1,64}:[A-Za-z0-9._~!$&*+=-]{4,128}@"),
)
RULES = BASE + EXTRA


# ---------------------------------------------------------------- trigram queries

def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The clauses (all trigrams of one of them must be in the lower-cased text)
    of an expression; an empty clause: no trigram is mandatory."""
    from re import _constants as op
    from re import _parser

    def fold(states):
        states = set(states)
        if len(states) > MAX_STATES:       # forget the text, keep what all alternatives demand
            states = {(frozenset.intersection(*(c for c, _ in states)), "")}
        return states

    def add(states, char):
        out = set()
        for clause, tail in states:
            run = tail + char.lower() if char.isascii() else ""
            out.add((clause | {run}, run[1:]) if len(run) == 3 else (clause, run))
        return out

    def gap(states):
        return {(clause, "") for clause, _ in states}

    def walk(tree, states):
        for kind, arg in tree:
            if kind is op.LITERAL:
                states = add(states, chr(arg))
            elif kind is op.IN and all(k is op.LITERAL for k, _ in arg) and len(arg) <= 8:
                states = fold(s for _, c in arg for s in add(states, chr(c)))
            elif kind is op.SUBPATTERN:
                states = walk(arg[-1], states)
            elif kind is op.BRANCH:
                states = fold(s for branch in arg[1] for s in walk(branch, states))
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
                low, high, body = arg
                if (low, high) == (0, 1):
                    states = fold(states | walk(body, states))
                    continue
                for _ in range(min(low, 3)):
                    states = walk(body, states)
                if (low, high) != (min(low, 3), min(low, 3)):
                    states = gap(states)
            elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
                pass                       # no width
            else:
                states = gap(states)
        return states

    clauses = {clause for clause, _ in walk(_parser.parse(pattern), {(frozenset(), "")})}
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def candidates(keyed: DataFrame, rules: Sequence[Rule], text_col: str, key: Sequence[str]) -> DataFrame | None:
    """(key, rules): documents and the places in ``rules`` of the indexable rules
    whose trigram query they satisfy.  None if no rule is indexable."""
    clauses = [(place, n, sorted(c)) for place, r in enumerate(rules)
               for n, c in enumerate(trigram_query(r.pattern)) if is_indexed(r)]
    if not clauses:
        return None
    named = sorted({t for _, _, c in clauses for t in c})
    low = keyed.select(*key, F.lower(F.col(text_col)).alias("low"))
    postings = low.select(*key, F.explode(F.array_compact(F.array(
        *[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(i)) for i, t in enumerate(named)]))).alias("trigram"))
    # A row per trigram of a clause: as many as the rules' expressions have.
    spark = keyed.sparkSession
    demand = spark.createDataFrame([(named.index(t), place, n, len(c)) for place, n, c in clauses for t in c],
                                   "trigram int, rule int, clause int, size int")
    met = (postings.join(F.broadcast(demand), "trigram").groupBy(*key, "rule", "clause", "size")
           .agg(F.count_distinct("trigram").alias("found")).where("found = size"))
    return met.groupBy(*key).agg(F.collect_set("rule").alias("rules"))


def is_indexed(rule: Rule) -> bool:
    return all(trigram_query(rule.pattern))


# ---------------------------------------------------------------- verification

def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _before(xs: Column) -> Column:
    """The sum of the elements before each one, in two levels of chunks."""
    def places(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def by_chunk(chunks):
        return _let(F.transform(chunks, _sum), lambda sums: F.flatten(F.transform(chunks, lambda chunk, c: _let(
            _sum(F.slice(sums, F.lit(1), c)), lambda base: F.transform(chunk, lambda _, i: base + _sum(F.slice(chunk, F.lit(1), i)))))))

    return _let(xs, lambda ys: _let(F.transform(
        places(F.ceil(F.size(ys) / CHUNK).cast("int")), lambda c: F.slice(ys, c * CHUNK + 1, F.lit(CHUNK))), by_chunk))


def spans_of(text: Column, rule: Rule, place: int) -> Column:
    """The rule's spans in ``text`` in order, each with the rule's place."""
    none = F.array().cast(f"array<{SPAN}>")
    pattern = F.lit(rule.pattern)

    def sizes(xs):
        return F.transform(xs, lambda x: F.length(x).cast("bigint"))

    def placed(found):
        judged = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
        return _let(sizes(found), lambda own: _let(
            F.zip_with(F.slice(sizes(F.split(text, rule.pattern, -1)), F.lit(1), F.size(found)), own,
                       lambda gap, n: F.struct(gap.alias("gap"), (gap + n).alias("both"))),
            lambda steps: _let(
                F.arrays_zip(_before(F.transform(steps, lambda s: s["both"])).alias("at"),
                             F.transform(steps, lambda s: s["gap"]).alias("gap"), own.alias("n"), sizes(judged).alias("held")),
                lambda rows: F.transform(
                    F.filter(rows, lambda r: r["held"] >= rule.least),
                    lambda r: F.struct((r["at"] + r["gap"]).alias("start"), F.lit(place).alias("place"),
                                       (r["at"] + r["gap"] + r["n"]).alias("end"))))))

    found = F.regexp_extract_all(text, pattern, F.lit(0))
    return F.coalesce(_let(found, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none)), none).cast(f"array<{SPAN}>")


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row: spans (start, place of the rule, end) sorted."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return _scanned(rows, rules).select("id", "spans")


def _scanned(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rows`` (id, text, ...) with their spans."""
    key = ["id", "h1", "h2"]
    rows = rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), F.col("text"))})
    found = candidates(rows, rules, "text", key)
    if found is None:
        joined = rows.withColumn("rules", F.lit(None).cast("array<int>"))
    else:
        found = written(found, "secret-candidates").select(*[F.col(k).alias(f"c_{k}") for k in key], "rules")
        same = [F.col("h1") == F.col("c_h1"), F.col("h2") == F.col("c_h2"), F.col("id").eqNullSafe(F.col("c_id"))]
        joined = rows.join(found, same[0] & same[1] & same[2], "left")
    text = F.col("text")
    parts = []
    for place, rule in enumerate(rules):
        spans = spans_of(text, rule, place)
        none = F.array().cast(f"array<{SPAN}>")
        parts.append(F.when(F.array_contains("rules", place), spans).otherwise(none) if is_indexed(rule) else spans)
    return joined.withColumn("spans", F.array_sort(F.concat(*parts)))


def kinds(spans: Column, rules: Sequence[Rule], first: int | None = None) -> Column:
    """``kind:start:end`` of the spans (of the first rules only), comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    some = spans if first is None else F.filter(spans, lambda s: s["place"] < first)
    return F.array_join(F.transform(some, lambda s: F.concat_ws(
        ":", F.element_at(names, s["place"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text",
         cover: str = "*") -> DataFrame:
    """``docs`` with every code point inside a span replaced by ``cover``; texts
    without spans, null ones too, stay as they are."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # Left to right: what follows the end of the spans so far is kept up to the next start.
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.array().cast("array<string>").alias("parts"))

    def step(state, s):
        begin = F.greatest(s["start"], state["end"])
        stop = F.greatest(s["end"], state["end"])
        kept = F.col("text").substr((state["end"] + 1).cast("int"), (begin - state["end"]).cast("int"))
        return F.struct(stop.alias("end"), F.concat(state["parts"], F.array(
            kept, F.repeat(F.lit(cover), (stop - begin).cast("int")))).alias("parts"))

    def finish(state):
        return F.concat(F.array_join(state["parts"], ""), F.col("text").substr((state["end"] + 1).cast("int"), F.length("text")))

    masked = F.when(F.size("spans") > 0, F.aggregate("spans", start, step, finish)).otherwise(F.col(f"row.`{text_col}`"))
    return _scanned(rows, rules).select(*[masked.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
