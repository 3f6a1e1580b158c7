"""Linking tool calls with their results, with DataFrame operations only.

Calls and results are joined by identifier. A call may name the call it follows; the depth in these chains is a topological
order and is found by pointer doubling, so a chain of n calls takes log n joins and no conversation is gathered in a task.
Arguments are validated against the tool's schema, and each call is written as JSON with sorted keys and no blanks.

Defined cases: of calls (or results) that repeat an identifier the smallest by content stands, and the number is told; a call
without identifier is kept, unlinked, at depth 0; a call that follows an unknown call is at depth 0; calls in a cycle have
no depth and the error 'cycle'; arguments that are no JSON object and tools without a schema are errors; a result without
a call gives no row; empty tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingmill.session import stage

SCHEMA_FIELDS = "name string, fields array<struct<field: string, type: string, required: boolean>>"
# Schema types and the kinds of JSON values they take.
KINDS = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|DECIMAL.*", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*"}


def _one_per_id(rows: DataFrame, key: str, n: str) -> DataFrame:
    """The smallest row of each identifier and the number of them; rows without one stay each."""
    rest = [c for c in rows.columns if c != key]
    named = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_r"), F.count("*").alias(n))
    return named.select(key, "_r.*", n).unionByName(rows.filter(F.col(key).isNull()).withColumn(n, F.lit(1).cast("bigint")))


def depths(calls: DataFrame) -> DataFrame:
    """call_id, depth of calls (call_id, follows) with unique identifiers; null depth in a cycle."""
    known = calls.select(F.col("call_id").alias("follows"))
    links = calls.select("call_id", "follows").join(known.withColumn("_k", F.lit(True)), "follows", "left")
    state = links.select("call_id", F.when(F.col("_k"), F.col("follows")).alias("jump"), F.when(F.col("_k"), 1).otherwise(0).cast("bigint").alias("depth"))
    state = stage(state, "depths")
    rounds = max(1, state.count().bit_length() + 1)
    for _ in range(rounds):
        if state.filter("jump IS NOT NULL").isEmpty():
            break
        far = state.select(F.col("call_id").alias("jump"), F.col("jump").alias("_next"), F.col("depth").alias("_more"))
        state = stage(
            state.join(far, "jump", "left").select("call_id", F.col("_next").alias("jump"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth")),
            "depths",
        )
    return state.select("call_id", F.when(F.col("jump").isNull(), F.col("depth")).alias("depth"))


def _errors(arguments: Column, fields: Column) -> Column:
    """What is wrong with an object's fields."""

    def wrong(f: Column) -> Column:
        held = F.map_contains_key(arguments, f["field"])
        kind = F.schema_of_variant(F.element_at(arguments, f["field"]))
        fits = F.lit(False)
        for name, pattern in KINDS.items():
            fits = fits | ((f["type"] == name) & kind.rlike(f"^({pattern})"))
        missing = F.when(~held & f["required"], F.concat(F.lit("missing "), f["field"]))
        return F.when(held & ~fits, F.concat(F.lit("type "), f["field"])).otherwise(missing)

    named = F.transform(fields, lambda f: f["field"])
    extra = F.transform(F.array_except(F.map_keys(arguments), named), lambda k: F.concat(F.lit("unknown "), k))
    return F.array_sort(F.concat(F.filter(F.transform(fields, wrong), lambda e: e.isNotNull()), extra))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """call_id, depth, name, n_calls, n_results, valid, errors, message.

    ``calls`` (call_id, follows, name, arguments), ``results`` (call_id, content), ``schemas`` (name, fields).
    """
    calls = stage(_one_per_id(calls.select("call_id", "follows", "name", "arguments"), "call_id", "n_calls"), "calls")
    results = _one_per_id(results.filter("call_id IS NOT NULL").select("call_id", "content"), "call_id", "n_results")
    placed = calls.join(depths(calls.filter("call_id IS NOT NULL")), "call_id", "left").join(results, "call_id", "left").join(schemas, "name", "left")
    parsed = placed.withColumn("_v", F.try_parse_json("arguments"))
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    parsed = parsed.withColumn("_m", F.when(is_object, F.col("_v")).cast("map<string,variant>"))
    cycle = F.col("call_id").isNotNull() & F.col("depth").isNull()
    errors = (
        F.when(F.col("_m").isNull(), F.array(F.lit("arguments are no object")))
        .when(F.col("fields").isNull(), F.array(F.lit("unknown tool")))
        .otherwise(_errors(F.col("_m"), F.col("fields")))
    )
    parsed = parsed.withColumn("errors", F.concat(errors, F.when(cycle, F.array(F.lit("cycle"))).otherwise(F.array().cast("array<string>"))))
    message = F.to_json(F.struct(F.col("_v").alias("arguments"), F.col("call_id").alias("id"), "name", F.col("content").alias("result")))
    depth = F.when(F.col("call_id").isNull(), F.lit(0)).otherwise(F.col("depth"))
    return parsed.select(
        "call_id",
        depth.cast("bigint").alias("depth"),
        "name",
        "n_calls",
        F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
        (F.size("errors") == 0).alias("valid"),
        F.array_join("errors", "; ").alias("errors"),
        message.alias("message"),
    )


def turn_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and schemas of chats: each turn that is not the assistant's is a call, and the assistant's next turn its result.

    A call follows the last call before the assistant's turn that precedes it, or the turn before if that is a call.
    Turns with a null conv_id or turn are left out, as in the query's SQL.
    """
    turns = conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("user")).alias("role"), "text"
    )
    name = lambda conv, turn: F.concat_ws("-", F.col(conv).cast("string"), turn.cast("string"))
    before = turns.groupBy("conv_id", (F.col("turn") + 1).alias("turn")).agg(F.max(F.col("role") == "assistant").alias("answered"))
    asked = turns.filter("role <> 'assistant'").join(before, ["conv_id", "turn"], "left")
    calls = asked.select(
        name("conv_id", F.col("turn")).alias("call_id"),
        F.when(F.col("answered").isNotNull(), name("conv_id", F.col("turn") - F.when(F.col("answered"), 2).otherwise(1))).alias("follows"),
        F.when(F.col("role") == "system", "configure").otherwise("reply").alias("name"),
        F.to_json(F.struct("turn", F.col("text").alias("prompt"))).alias("arguments"),
    )
    results = turns.filter("role = 'assistant'").select(name("conv_id", F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    fields = [("prompt", "string", True), ("turn", "integer", True)]
    schemas = conversations.sparkSession.createDataFrame([("configure", fields), ("reply", fields)], SCHEMA_FIELDS)
    return calls, results, schemas
