"""Chat formatting: tool-call linking, with DataFrame functions only.

Calls and results are hash-joined by (conversation, identifier). A call may
name the call it follows; its level in that forest is found by pointer
doubling (a number of joins logarithmic in the longest chain, whatever the
size of a conversation), so (level, turn, call_id) is a topological order.
Arguments are parsed to variants and checked against the tool's schema, and
each call is written as canonical JSON: sorted keys, no spaces.

No conversation is gathered into one row or task: all joins and aggregates
are on single calls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut

# The variant types that each JSON schema type accepts.
TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|DECIMAL)", "boolean": "^BOOLEAN$",
         "array": "^ARRAY", "object": "^OBJECT"}


@dataclass(frozen=True)
class Argument:
    """One argument of a tool's schema."""

    name: str
    type: str
    required: bool = True
    minimum: float | None = None
    maximum: float | None = None
    choices: tuple[str, ...] = ()


def _problems(args: Column, schema: list[Argument]) -> Column:
    """Sorted problems of a parsed object against one schema."""
    found = []
    for a in schema:
        if not a.name.isidentifier():
            raise ValueError(f"argument name {a.name!r}")
        path = f"$.{a.name}"
        value = F.try_variant_get(args, path, "variant")
        kind = F.schema_of_variant(value)
        present = value.isNotNull() & ~F.coalesce(kind == "VOID", F.lit(False))
        checks = [F.when(~kind.rlike(TYPES[a.type]), f"type:{a.name}")]
        number = F.try_variant_get(args, path, "double")
        if a.minimum is not None:
            checks.append(F.when(number < a.minimum, f"minimum:{a.name}"))
        if a.maximum is not None:
            checks.append(F.when(number > a.maximum, f"maximum:{a.name}"))
        if a.choices:
            checks.append(F.when(~F.try_variant_get(args, path, "string").isin(*a.choices), f"choice:{a.name}"))
        found.append(F.when(present, F.coalesce(*checks)).otherwise(F.lit(f"missing:{a.name}") if a.required else F.lit(None).cast("string")))
    keys = F.coalesce(F.json_object_keys(F.to_json(args)), F.array().cast("array<string>"))
    unknown = F.transform(F.filter(keys, lambda k: ~k.isin(*[a.name for a in schema])), lambda k: F.concat(F.lit("unknown:"), k))
    return F.array_sort(F.concat(F.filter(F.array(*found), lambda x: x.isNotNull()), unknown))


def validate(name: Column, args: Column, tools: dict[str, list[Argument]]) -> Column:
    """Problems of a call: of its tool's schema, or ``tool`` (no such tool)
    or ``json`` (arguments are no JSON object)."""
    is_object = F.coalesce(F.schema_of_variant(args).startswith("OBJECT"), F.lit(False))
    out = F.when(~is_object, F.array(F.lit("json")))
    for tool, schema in tools.items():
        out = out.when(name == tool, _problems(args, schema))
    return out.otherwise(F.array(F.lit("tool")))


def levels(calls: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(conv_id, call_id, level): 0 for a call that follows none (or one that
    is not there), else one more than the call it follows; NULL on a cycle or
    behind one. ``calls``: conv_id, call_id, after; of repeated ids the
    smallest ``after`` counts; NULL ids are left out."""
    nodes = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min("after").alias("after"))
    nodes = cut(nodes)
    ids = nodes.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("there"))
    state = cut(nodes.join(ids, ["conv_id", "after"], "left").select(
        "conv_id", "call_id", F.when(F.col("there"), F.col("after")).alias("up"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("level")))
    left = state.where("up IS NOT NULL").count()
    for _ in range(max_rounds):
        if not left:
            break
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("far"), F.col("level").alias("more"))
        state = cut(state.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "call_id", F.col("far").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")))
        before, left = left, state.where("up IS NOT NULL").count()
        if left == before:  # a chain would have shrunk: only cycles remain
            break
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, tools: dict[str, list[Argument]]) -> DataFrame:
    """``calls``: conv_id, turn, call_id, name, arguments (JSON text), after
    (call_id or NULL); ``results``: conv_id, turn, call_id, content. One row
    per call: conv_id, turn, call_id, level, n_results, status, problems
    (comma-joined), json. (level, turn, call_id) orders a conversation so that
    each call comes after the one it follows.

    status: invalid (problems), cycle, unanswered (no result at all), early
    (the first result is not after the call), else linked. The first result
    by (turn, content) counts. NULL ids link nothing and have level 0;
    repeated calls give repeated rows; results without a call are
    left out (see ``orphan_results``); empty tables give no rows; other
    columns are not read.
    """
    answers = results.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("turn").cast("long").alias("turn"), F.col("content").cast("string").alias("content"))).alias("first"))
    at = levels(calls)
    args = F.try_parse_json(F.col("arguments").cast("string"))
    # hash joins on the identifiers; a skewed side is split at run time
    linked = (calls.select("conv_id", "turn", "call_id", "name", "arguments")
              .join(answers.hint("shuffle_hash"), ["conv_id", "call_id"], "left").join(at, ["conv_id", "call_id"], "left")
              .withColumn("level", F.when(F.col("conv_id").isNull() | F.col("call_id").isNull(), F.lit(0)).otherwise(F.col("level")))
              .withColumn("args", args).withColumn("problems", validate(F.col("name"), args, tools)))
    status = (F.when(F.size("problems") > 0, "invalid").when(F.col("level").isNull(), "cycle")
              .when(F.col("n").isNull(), "unanswered").when(F.col("first.turn") <= F.col("turn"), "early").otherwise("linked"))
    linked = linked.withColumn("status", status)
    message = F.to_json(F.struct(  # keys in sorted order
        F.col("args").alias("arguments"), F.col("call_id"), F.col("conv_id"), F.col("level"), F.col("name"),
        F.when(F.col("status") == "linked", F.col("first.content")).alias("result"), F.col("status")), {"ignoreNullFields": "false"})
    return linked.select("conv_id", "turn", "call_id", "level", F.coalesce("n", F.lit(0)).alias("n_results"), "status",
                         F.array_join("problems", ",").alias("problems"), message.alias("json"))


def orphan_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """The rows of ``results`` whose identifier no call of the conversation has."""
    ids = cut(calls.select("conv_id", "call_id").where("conv_id IS NOT NULL AND call_id IS NOT NULL").distinct())
    return results.join(ids, ["conv_id", "call_id"], "left_anti")
