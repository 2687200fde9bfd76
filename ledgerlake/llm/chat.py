"""Tool calls and results of chats: linked, ordered, validated, serialised.

* Results are hash-joined to calls by (conversation, call id).
* Calls that use another call's result come after it: the depth of every call
  in the forest of these dependencies is found by pointer jumping (log of the
  longest chain rounds, one self join each), whatever the size of a
  conversation.  Sorting by (conversation, depth, turn) is a topological order.
* Arguments are parsed as variants and checked against the tool's schema.
* Output is one JSON object a row in one spelling: keys sorted, no white space,
  fields without a value left out.  Inside ``arguments`` a null that was given
  stays, whole numbers and decimals are written without trailing zeros, and a
  number with an exponent is written as a double.

DataFrame functions only.  No conversation is gathered in one place: a result
row is a call or a result, so a conversation with a third of all rows is just
many rows; joins on hot keys are left to be split at run time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# tool -> argument -> type (and bounds), as in JSON Schema.
Schemas = Mapping[str, Mapping[str, Mapping]]
_TYPES = {"string": "^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
          "boolean": "^BOOLEAN$", "array": "^ARRAY<", "object": "^OBJECT<"}


def _member(key: str) -> str:
    """Path of an argument, whatever characters its name has."""
    if "'" in key and '"' in key:
        raise ValueError(f"an argument's name cannot hold both kinds of quotes: {key!r}")
    return f'$["{key}"]' if "'" in key else f"$['{key}']"


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Sorted array of what is wrong with a call's arguments; empty if valid.

    ``unknown tool``, ``not an object`` (null, no JSON, repeated keys, or another
    value), and per argument ``k: missing``, ``k: unknown``, ``k: type``, ``k: length``,
    ``k: minimum``."""
    v = F.try_parse_json(arguments)
    out = F.when(name.isNull() | ~name.isin(*schemas), F.array(F.lit("unknown tool")))
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    for tool, fields in sorted(schemas.items()):
        checks = []
        for key, rule in sorted(fields.items()):
            path = _member(key)
            at = F.try_variant_get(v, path, "variant")
            kind = F.schema_of_variant(at)
            fits = kind.rlike(_TYPES[rule["type"]])
            if rule.get("required"):
                checks.append(F.when(kind.isNull(), F.lit(f"{key}: missing")))
            checks.append(F.when(~fits, F.lit(f"{key}: type")))
            if "max_length" in rule:
                text = F.try_variant_get(v, path, "string")
                checks.append(F.when(fits & (F.length(text) > rule["max_length"]), F.lit(f"{key}: length")))
            if "minimum" in rule:
                number = F.try_variant_get(v, path, "double")
                checks.append(F.when(fits & (number < rule["minimum"]), F.lit(f"{key}: minimum")))
        keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
        unknown = F.transform(F.array_except(keys, F.array(*[F.lit(k) for k in sorted(fields)])),
                              lambda k: F.concat(k, F.lit(": unknown")))
        found = F.array_sort(F.concat(F.array_compact(F.array(*checks)), unknown))
        out = out.when((name == tool) & ~is_object, F.array(F.lit("not an object"))).when(name == tool, found)
    return out


def call_depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) for distinct calls (conv_id, call_id, after):
    0 without a known ``after``, else one more than its depth; null in or behind
    a cycle."""
    keys = ["conv_id", "call_id"]
    known = calls.select("conv_id", F.col("call_id").alias("after"))
    linked = (calls.where("after IS NOT NULL").join(known, ["conv_id", "after"], "left_semi")
              .select(*keys, F.col("after").alias("ptr")))
    nodes = written(calls.select(*keys).join(linked, keys, "left").select(
        *keys, "ptr", F.col("ptr").isNotNull().cast("long").alias("depth")), "chat-depth")
    n = nodes.count()
    open_ = nodes.where("ptr IS NOT NULL").count()
    rounds = 0
    # A chain of n calls is done after log2(n) rounds; what is open then is on
    # a cycle or leads to one.
    while open_ and 2 ** rounds <= 2 * n:
        to = nodes.select("conv_id", F.col("call_id").alias("ptr"), F.col("ptr").alias("far"), F.col("depth").alias("more"))
        going = nodes.where("ptr IS NOT NULL").join(to, ["conv_id", "ptr"]).select(
            *keys, F.col("far").alias("ptr"), (F.col("depth") + F.col("more")).alias("depth"))
        nodes = written(nodes.where("ptr IS NULL").unionByName(going), "chat-depth")
        open_ = nodes.where("ptr IS NOT NULL").count()
        rounds += 1
    return nodes.select(*keys, F.when(F.col("ptr").isNull(), F.col("depth")).alias("depth"))


def _firsts(rows: DataFrame, hash_cols: list[str]) -> DataFrame:
    """(conv_id, call_id, mark) of the first row of every id, by turn and content."""
    mark = F.struct(F.coalesce("turn", F.lit(-1).cast("long")).alias("turn"), F.xxhash64(*hash_cols).alias("h"))
    return rows.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min(mark).alias("mark"))


def _marked(rows: DataFrame, hash_cols: list[str]) -> DataFrame:
    first = _firsts(rows, hash_cols)
    mark = F.struct(F.coalesce("turn", F.lit(-1).cast("long")).alias("turn"), F.xxhash64(*hash_cols).alias("h"))
    keyed = rows.where("conv_id IS NOT NULL AND call_id IS NOT NULL").join(first, ["conv_id", "call_id"])
    keyed = keyed.withColumn("is_first", mark == F.col("mark")).drop("mark")
    return keyed.unionByName(rows.where("conv_id IS NULL OR call_id IS NULL").withColumn("is_first", F.lit(False)))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """A row per call and per result without its call: (conv_id, call_id, turn,
    depth, status, result_turn, errors, json).

    ``calls``: conv_id, call_id, after (the call whose result it uses), turn, name,
    arguments (JSON text).  ``results``: conv_id, call_id, turn, content.  Status:

    * ``linked``, ``unanswered``: a call with and without a result;
    * ``duplicate``: a call whose id an earlier call of the conversation has, or
      with a null id or conversation; it is linked to nothing;
    * ``orphan``: a result without a call or with a null id;
    * ``repeated``: a result after the first one of its id.

    Rows that agree in everything count as one place and are all kept."""
    c = _marked(calls.select("conv_id", "call_id", "after", F.col("turn").cast("long"), "name", "arguments"),
                ["after", "name", "arguments"])
    r = _marked(results.select("conv_id", "call_id", F.col("turn").cast("long"), "content"), ["content"])
    keys = ["conv_id", "call_id"]
    distinct = c.where("is_first").groupBy(*keys).agg(F.min("after").alias("after"))
    depths = call_depths(distinct)
    answer = r.where("is_first").dropDuplicates(keys).select(*keys, F.col("turn").alias("result_turn"), "content",
                                                            F.lit(True).alias("answered"))
    head = c.where("is_first").join(depths, keys, "left").join(answer, keys, "left")
    status = F.when(F.col("answered"), "linked").otherwise("unanswered")
    rest = c.where("not is_first").withColumns({"depth": F.lit(None).cast("long"), "result_turn": F.lit(None).cast("long"),
                                                "content": F.lit(None).cast("string")})
    cols = [*keys, "turn", "depth", "status", "result_turn", "name", "arguments", "after", "content"]
    made = head.withColumn("status", status).select(*cols).unionByName(rest.withColumn("status", F.lit("duplicate")).select(*cols))
    made = made.withColumn("errors", argument_errors(F.col("name"), F.col("arguments"), schemas))
    lone = r.join(distinct.select(*keys), keys, "left_anti").withColumn("status", F.lit("orphan"))
    late = r.where("not is_first").join(distinct.select(*keys), keys, "left_semi").withColumn("status", F.lit("repeated"))
    for_result = {"depth": F.lit(None).cast("long"), "result_turn": F.col("turn"), "name": F.lit(None).cast("string"),
                  "arguments": F.lit(None).cast("string"), "after": F.lit(None).cast("string"),
                  "errors": F.array().cast("array<string>")}
    others = lone.unionByName(late).withColumns(for_result).select(*cols, "errors")
    out = made.unionByName(others)
    body = F.to_json(F.struct(F.col("after"), F.try_parse_json("arguments").alias("arguments"), "call_id", "content", "conv_id",
                              F.when(F.size("errors") > 0, F.col("errors")).alias("errors"), "name", "status"))
    return out.select(*keys, "turn", "depth", "status", "result_turn", "errors", body.alias("json"))
