"""Tool calls and their results in conversations, linked, ordered and checked.

A message with calls holds {"tool_calls": [{"id", "name", "arguments", "after": [ids]}]};
a result holds {"tool_call_id", "content"}. Calls and results meet in a hash join by
conversation and identifier. Calls are ordered so that each comes after those it names,
where chains of calls are followed by doubling.
Arguments are checked against schemas, and written as JSON with sorted keys and no
blanks. Only built-in expressions.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editflow.functions.skew import as_of
from editflow.llm.tables import stored

# Per tool and argument: its type, whether it must be there, and the least number or the
# allowed strings.
SCHEMAS: Mapping[str, Mapping[str, tuple]] = {
    "reply": {
        "chars": ("bigint", True, 1),
        "words": ("bigint", True, 1),
        "role": ("string", True, ("user",)),
    },
    "configure": {
        "chars": ("bigint", True, 1),
        "words": ("bigint", False, 1),
        "role": ("string", True, ("system",)),
    },
}

_CALLS = "tool_calls array<struct<id: string, name: string, arguments: string, after: array<string>>>"


def as_messages(turns: DataFrame) -> DataFrame:
    """Plain conversations (conv_id, turn, role, text) as messages of calls and results.

    Each turn that is not an assistant's asks for an answer: a call whose arguments
    describe its text, after the last call before it. Each assistant's turn is a result of
    the last call before it, however many answers lie between; `linked_calls` takes the
    earliest of a call's results, of several at one turn the one with the smallest text.
    Answers before the first call belong to nothing.
    """
    text = F.coalesce("text", F.lit(""))
    call = F.col("turn").cast("string")
    name = F.when(F.col("role").eqNullSafe("system"), "configure").otherwise("reply")
    arguments = F.to_json(
        F.struct(
            F.coalesce("role", F.lit("")).alias("role"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
            F.length(text).alias("chars"),
        )
    )
    kept = turns.where("turn is not null and conv_id is not null").select(
        "conv_id", "turn", "role", F.col("text").cast("string")
    )
    asks = kept.where("not (role <=> 'assistant')").groupBy("conv_id", "turn").agg(F.count("*").alias("_n"))
    versions = asks.select("conv_id", F.col("turn").alias("_since"), F.col("turn").alias("_named"))
    # One range sort over conversations and turns, so that a long conversation is dealt over many tasks.
    rows = kept.withColumn("_at", F.col("turn") - 1)
    linked = stored(as_of(rows, versions, ["conv_id"], "_at", "_since", ["_named"], "left"), "linked")
    asked = linked.where("not (role <=> 'assistant')").select(
        "conv_id",
        "turn",
        F.lit("assistant").alias("role"),
        F.to_json(
            F.struct(
                F.array(
                    F.struct(
                        call.alias("id"),
                        name.alias("name"),
                        arguments.alias("arguments"),
                        F.array_compact(F.array(F.col("_named").cast("string"))).alias("after"),
                    )
                ).alias("tool_calls")
            )
        ).alias("text"),
    )
    answered = linked.where("role = 'assistant' and _named is not null").select(
        "conv_id",
        "turn",
        F.lit("tool").alias("role"),
        F.to_json(F.struct(F.col("_named").cast("string").alias("tool_call_id"), F.col("text").alias("content"))).alias("text"),
    )
    return asked.unionByName(answered)


def linked_calls(messages: DataFrame, schemas: Mapping[str, Mapping[str, tuple]] = SCHEMAS) -> DataFrame:
    """One row per call: conv_id, turn, call_id, name, level, arguments, valid, result_turn, result.

    messages: conv_id, turn, role, text. level is the longest chain of earlier calls the
    call comes after; ordering by level, turn and call_id is a topological order. Calls in
    a cycle, or after one, have a null level. Of calls with one identifier in a
    conversation the earliest counts, of results the earliest after its call; results of
    unknown calls and names of unknown calls in `after` are ignored. arguments is
    canonical JSON, null if it is none; valid says that it fits the schema of the name.
    Messages that hold neither calls nor a result give nothing, nor do nulls in conv_id.
    """
    plain = messages.select("conv_id", F.col("turn").cast("long"), "role", F.col("text").cast("string"))
    plain = plain.where("conv_id is not null and text is not null")
    calls = plain.where("role = 'assistant'").select(
        "conv_id", "turn", F.explode(F.from_json("text", _CALLS).getField("tool_calls")).alias("call")
    )
    calls = calls.select("conv_id", "turn", "call.*").where("id is not null").withColumnRenamed("id", "call_id")
    rest = F.struct("turn", "name", "arguments", "after")
    calls = calls.groupBy("conv_id", "call_id").agg(F.min(rest).alias("first"))
    calls = stored(calls.select("conv_id", "call_id", "first.*"), "calls")
    result = F.from_json("text", "tool_call_id string, content string")
    results = plain.where("role = 'tool'").select("conv_id", F.col("turn").alias("result_turn"), result.alias("r"))
    results = results.select("conv_id", "result_turn", F.col("r.tool_call_id").alias("call_id"), F.col("r.content").alias("result"))
    keys = calls.select("conv_id", "call_id", "turn").hint("shuffle_hash")
    met = results.join(keys, ["conv_id", "call_id"]).where("result_turn > turn")
    first = met.groupBy("conv_id", "call_id").agg(F.min(F.struct("result_turn", "result")).alias("r"))
    first = first.select("conv_id", "call_id", "r.result_turn", "r.result")
    ordered = calls.join(levels(calls), ["conv_id", "call_id"], "left").join(
        first.hint("shuffle_hash"), ["conv_id", "call_id"], "left"
    )
    parsed = F.try_parse_json("arguments")
    return ordered.select(
        "conv_id",
        "turn",
        "call_id",
        "name",
        "level",
        F.to_json(parsed).alias("arguments"),
        F.coalesce(fits(F.col("name"), parsed, schemas), F.lit(False)).alias("valid"),
        "result_turn",
        "result",
    )


def fits(name: Column, arguments: Column, schemas: Mapping[str, Mapping[str, tuple]]) -> Column:
    """Whether arguments (a variant) fit the schema of a tool; unknown tools and arguments don't."""
    known = F.from_json(F.to_json(arguments), "map<string, string>")
    out = F.lit(False)
    for tool, fields in schemas.items():
        names = F.array(*(F.lit(f) for f in fields))
        good = F.size(F.array_except(F.map_keys(known), names)) == 0
        for field, (kind, required, bound) in fields.items():
            value = F.try_variant_get(arguments, f"$.{field}", kind)
            # The type is that of the JSON value: a number in quotes is a string.
            written = F.schema_of_variant(F.try_variant_get(arguments, f"$.{field}", "variant"))
            within = value >= bound if kind == "bigint" else value.isin(*bound)
            within &= written == kind.upper()
            there = F.array_contains(F.map_keys(known), field)
            good &= F.when(there, F.coalesce(within, F.lit(False))).otherwise(F.lit(not required))
        out = F.when(name == tool, good).otherwise(out)
    return out


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level: the longest chain of earlier calls; none for calls in or after a cycle.

    A call that names one known call only passes its level on. Such chains are followed by
    doubling: after k rounds a call points 2^k calls back, or at the call where its chain
    starts. That is a root, or a call that names several. Only the latter are released
    in turn, so a long conversation costs rounds by the logarithm of its length plus its
    longest chain of calls with several names.
    """
    known = calls.select("conv_id", F.col("call_id").alias("named"))
    named = calls.select("conv_id", "call_id", F.explode("after").alias("named")).distinct()
    edges = stored(named.join(known, ["conv_id", "named"]), "edges")
    ends = stored(_chains(calls, edges), "ends")
    level = ends.where("root").select("conv_id", "call_id", F.col("distance").alias("level"))
    several = ends.where("not root and call_id = top").select("conv_id", "call_id")
    if several.isEmpty():
        return level
    starts = _released(edges.join(several, ["conv_id", "call_id"]), ends)
    later = ends.where("not root").join(starts.withColumnRenamed("call_id", "top"), ["conv_id", "top"])
    later = later.select("conv_id", "call_id", (F.col("level") + F.col("distance")).alias("level"))
    return level.unionByName(later)


def _chains(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """conv_id, call_id, top, distance, root: where each call's chain starts, and how far back.

    root says that top names no known call. Chains that end in a cycle are left out.
    """
    names = edges.groupBy("conv_id", "call_id").agg(F.count("*").alias("n"), F.min("named").alias("named"))
    one = F.col("n") == 1
    first = calls.select("conv_id", "call_id").join(names, ["conv_id", "call_id"], "left").select(
        "conv_id",
        "call_id",
        F.when(one, F.col("named")).otherwise(F.col("call_id")).alias("top"),
        F.when(one, 1).otherwise(0).cast("long").alias("distance"),
        F.when(F.col("n").isNull(), True).when(~one, False).alias("root"),
    )
    rounds, before = [stored(first, "chains")], -1
    while True:
        going = rounds[-1].where("root is null")
        # A round ends some chains if any are left that end at all.
        left = going.count()
        ended = reduce(DataFrame.unionByName, [r.where("root is not null") for r in rounds])
        if left in (0, before):
            return ended
        before = left
        step = ended.unionByName(going).select(
            "conv_id",
            F.col("call_id").alias("top"),
            F.col("top").alias("_top"),
            F.col("distance").alias("_distance"),
            "root",
        )
        further = going.drop("root").join(step, ["conv_id", "top"]).select(
            "conv_id",
            "call_id",
            F.col("_top").alias("top"),
            (F.col("distance") + F.col("_distance")).alias("distance"),
            "root",
        )
        rounds.append(stored(further, "chains"))


def _released(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """conv_id, call_id, level of the calls that name several, each once all it names have a level."""
    back = ends.withColumnRenamed("call_id", "named")
    far = F.col("distance") + 1
    waiting = edges.join(back, ["conv_id", "named"], "left").select(
        "conv_id", "call_id", "top", far.alias("far"), F.when(F.col("root"), far).alias("level")
    )
    waiting, done = stored(waiting, "waiting"), []
    while True:
        ready = waiting.groupBy("conv_id", "call_id").agg(
            F.bool_and(F.col("level").isNotNull()).alias("ready"), F.max("level").alias("level")
        )
        ready = stored(ready.where("ready").drop("ready"), "ready")
        done.append(ready)
        if ready.isEmpty():
            return reduce(DataFrame.unionByName, done)
        there = ready.select("conv_id", F.col("call_id").alias("top"), F.col("level").alias("_level"))
        rest = waiting.join(ready, ["conv_id", "call_id"], "left_anti").join(there, ["conv_id", "top"], "left")
        level = F.coalesce("level", F.col("_level") + F.col("far"))
        waiting = stored(rest.select("conv_id", "call_id", "top", "far", level.alias("level")), "waiting")
