"""Tool-call linking: calls joined with their results by identifier, ordered, checked against schemas, and written as canonical JSON.

DataFrame functions only. ``calls`` has (conv_id, call_id, position, name, arguments, needs): ``arguments`` is JSON text, ``needs`` an array of call_ids
of the same conversation whose results the call uses. ``results`` has (conv_id, call_id, position, content). ``schemas`` maps a tool's name to its fields, each a type
(``string``, ``integer``, ``number``, ``boolean``, ``array``, ``object``) with a leading ``?`` if it may be left out.

- Identifiers are unique within a conversation. Of rows repeating one, the one with the smallest (position, content) counts; ``repeats`` tells how many others there are.
- A call without a result is ``pending``; a result without a call appears as a row of its own with no name (``orphan``). Rows without conv_id or call_id
  link with nothing and are left out, as nothing could refer to them.
- Order: (``stage``, ``position``, ``call_id``) puts every call after those it needs. Conversations in which needs only point backwards keep stage 0 and
  so their own order. In the others a stage is the length of the longest chain of needs below a call: found by doubling where every call of the conversation has one need
  at most, else by peeling off calls whose needs are all placed, one stage per round.
  Calls on a cycle, or that need one, have a null stage, sort last, and are reported. Needs that name no call are ignored.
- ``problem`` is the first of: ``malformed`` (not a JSON object), ``unknown tool``, ``missing FIELD``, ``type FIELD``, ``extra FIELD`` (fields in name order), ``cycle``; else null.
- ``line`` is one JSON object with sorted keys and no white space. Arguments that do not parse are kept as a string.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.shared import stored

KEY = ["conv_id", "call_id"]

# How a variant's own type names start, by schema type.
TYPES = {
    "string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DECIMAL|DOUBLE|FLOAT)", "boolean": "BOOLEAN", "array": "ARRAY", "object": "OBJECT",
}


def first_of_each(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per (conv_id, call_id), the smallest by ``columns`` in their order, with the number of others."""
    kept = rows.where("conv_id is not null and call_id is not null").groupBy(*KEY).agg(F.min(F.struct(*columns)).alias("row"), (F.count("*") - 1).alias("repeats"))
    return kept.select(*KEY, "row.*", "repeats")


def _field_problems(value: Column, fields: dict[str, str]) -> list[Column]:
    names = sorted(fields)
    found = {n: F.try_variant_get(value, f"$.{n}", "variant") for n in names}
    missing = [F.when(found[n].isNull(), F.lit(f"missing {n}")) for n in names if not fields[n].startswith("?")]
    wrong = [
        F.when(found[n].isNotNull() & ~F.schema_of_variant(found[n]).rlike("^" + TYPES[fields[n].lstrip("?")]), F.lit(f"type {n}")) for n in names
    ]
    return missing + wrong


def problem_of(name: Column, arguments: Column, schemas: dict[str, dict[str, str]]) -> Column:
    """The first thing wrong with a call's arguments, or null."""
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    out = F.lit("unknown tool")
    for tool in sorted(schemas, reverse=True):
        extra = F.array_sort(F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(f) for f in sorted(schemas[tool])]).cast("array<string>")))
        more = F.when(F.size(extra) > 0, F.concat(F.lit("extra "), extra[0]))
        out = F.when(name == tool, F.coalesce(*_field_problems(value, schemas[tool]), more)).otherwise(out)
    return F.when(~is_object, F.lit("malformed")).otherwise(out)


def _quoted(text: Column) -> Column:
    """A JSON string; ``null`` for a null text."""
    return F.when(text.isNull(), F.lit("null")).otherwise(F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1))


def line_of() -> Column:
    """Canonical JSON of a linked call: keys in name order."""
    value = F.try_parse_json(F.col("arguments"))
    arguments = F.when(value.isNotNull(), F.to_json(value)).otherwise(_quoted(F.col("arguments")))
    parts = [('{"arguments":', arguments), (',"id":', _quoted(F.col("call_id"))), (',"name":', _quoted(F.col("name"))), (',"result":', _quoted(F.col("content")))]
    return F.concat(*[c for key, value in parts for c in (F.lit(key), value)], F.lit("}"))


def stages(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, stage) of the calls of conversations in which a need points forwards; null on or above a cycle."""
    needs = calls.select(*KEY, "position", F.explode("needs").alias("needed")).distinct()
    known = calls.select("conv_id", F.col("call_id").alias("needed"), F.col("position").alias("at"))
    edges = needs.hint("shuffle_hash").join(known, ["conv_id", "needed"])
    # positions may be equal or unknown; only a need that surely comes before is in order already
    ahead = edges.where(~F.coalesce(F.col("at") < F.col("position"), F.lit(False))).select("conv_id").distinct()
    edges = stored(edges.join(ahead, "conv_id", "left_semi").select(*KEY, "needed"), "needs")
    moved = stored(calls.join(ahead, "conv_id", "left_semi").select(*KEY), "moved")
    several = stored(edges.groupBy(*KEY).count().where("count > 1").select("conv_id").distinct(), "several")
    chains = _chain_stages(moved.join(several, "conv_id", "left_anti"), edges.join(several, "conv_id", "left_anti"))
    return chains.unionByName(_graph_stages(moved.join(several, "conv_id", "left_semi"), edges.join(several, "conv_id", "left_semi")))


def _chain_stages(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """Calls with one need at most: every round doubles the distance looked down the chain, so rounds are few however long it is."""
    state = stored(calls.join(edges, KEY, "left").select(*KEY, F.col("needed").alias("target"), F.when(F.col("needed").isNull(), 0).otherwise(1).alias("stage")), "chain")
    longest = state.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(longest.bit_length()):
        there = state.select("conv_id", F.col("call_id").alias("target"), F.col("target").alias("next"), F.col("stage").alias("more"))
        further = state.where("target is not null").join(there, ["conv_id", "target"]).select(*KEY, F.col("next").alias("target"), (F.col("stage") + F.col("more")).alias("stage"))
        state = stored(state.where("target is null").unionByName(further), "chain")
    return state.select(*KEY, F.when(F.col("target").isNull(), F.col("stage")).alias("stage"))


def _graph_stages(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """Calls with several needs: one round per stage, with one write, counts down the needs of the calls still open and places those that have none left."""
    edges = stored(edges, "needs")
    left = F.coalesce("left", F.lit(0).cast("long"))
    state, done, stage = stored(calls.join(edges.groupBy(*KEY).agg(F.count("*").alias("left")), KEY, "left").withColumn("left", left), "open"), [], 0
    while not (free := state.where("left = 0").select(*KEY)).isEmpty():
        done.append(free.withColumn("stage", F.lit(stage)))
        met = edges.join(free.withColumnRenamed("call_id", "needed"), ["conv_id", "needed"]).groupBy(*KEY).agg(F.count("*").alias("met"))
        state = stored(state.where("left > 0").join(met, KEY, "left").select(*KEY, (F.col("left") - F.coalesce("met", F.lit(0))).alias("left")), "open")
        stage += 1
    return reduce(DataFrame.unionByName, done, state.where("left > 0").select(*KEY, F.lit(None).cast("int").alias("stage")))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, str]]) -> DataFrame:
    """Per call: conv_id, call_id, position, stage, name, state, repeats, problem, line; and a row for each result without a call."""
    wanted = calls.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("call_id").cast("string").alias("call_id"), F.col("position").cast("long").alias("position"),
        F.col("name").cast("string").alias("name"), F.col("arguments").cast("string").alias("arguments"), F.coalesce(F.col("needs"), F.array()).cast("array<string>").alias("needs"),
    )
    once = stored(first_of_each(wanted, ["position", "name", "arguments", "needs"]), "calls")
    given = results.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("call_id").cast("string").alias("call_id"), F.col("position").cast("long").alias("answered"),
        F.col("content").cast("string").alias("content"),
    )
    answers = first_of_each(given, ["answered", "content"]).withColumn("result", F.lit(True)).drop("repeats")
    moved = stages(once).withColumn("moved", F.lit(True))
    linked = once.withColumn("call", F.lit(True)).join(answers.hint("shuffle_hash"), KEY, "full").join(moved, KEY, "left")
    state = F.when(F.col("call").isNull(), "orphan").when(F.col("result").isNull(), "pending").otherwise("linked")
    cycle = F.when(F.col("moved") & F.col("stage").isNull(), F.lit("cycle"))
    return linked.select(
        *KEY, F.coalesce("position", "answered").alias("position"), F.when(F.col("moved"), F.col("stage")).otherwise(F.lit(0)).alias("stage"), "name", state.alias("state"),
        F.coalesce("repeats", F.lit(0).cast("long")).alias("repeats"),
        F.when(F.col("call"), F.coalesce(problem_of(F.col("name"), F.col("arguments"), schemas), cycle)).alias("problem"), line_of().alias("line"),
    )
