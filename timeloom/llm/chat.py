"""Chat formatting by tool-call linking, with DataFrame functions only (operator 6).

Messages are rows (conv_id, turn, role, text). An assistant's text may be a JSON
object {"content", "tool_calls": [{"id", "name", "arguments"}]}, a tool's text
{"tool_call_id", "content"}; any other text is plain content. Arguments may name
the result of an earlier call as {"$result": "<call id>"}.

Calls and results are hash-joined by conversation and identifier; messages are
put in topological order (a result after its call, a call after the results it
names), moving only those that stand too early; arguments are checked against
schemas; each message becomes one line of canonical JSON: sorted keys, no blanks.
One row per message, so a conversation of any length is never one task's work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timeloom.llm.runtime import Scratch

CALL = "struct<id:string,name:string,arguments:variant>"
#: Types of schema_of_variant that a JSON schema type admits.
ADMITS = {"integer": "BIGINT", "number": "BIGINT|DOUBLE|DECIMAL.*", "string": "STRING", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*"}

#: Waves of the topological order that are read as tables of their own.
WAVES = 16


def tool_schemas(spark: SparkSession, tools: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """(name, param, type, required) from {tool: {parameter: (type, required)}}."""
    rows = [(t, p, kind, needed) for t, params in tools.items() for p, (kind, needed) in params.items()]
    return spark.createDataFrame(rows, "name string, param string, type string, required boolean")


def _admitted(kind: Column, found: Column) -> Column:
    out = F.lit(False)
    for name, pattern in ADMITS.items():
        out = F.when(kind == name, found.rlike(f"^({pattern})$")).otherwise(out)
    return out


def argument_problems(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """calls (…, name, arguments) with problems: missing, unknown and ill-typed parameters, sorted; an unknown tool is one."""
    wanted = schemas.groupBy(F.col("name").alias("tool")).agg(F.map_from_entries(F.collect_set(F.struct("param", F.struct("type", "required")))).alias("params"))
    given = calls.join(wanted, F.col("name") == F.col("tool"), "left")
    args = F.try_variant_get("arguments", "$", "map<string,variant>")
    entries = F.coalesce(F.map_entries(args), F.array().cast("array<struct<key:string,value:variant>>"))
    missing = F.transform(F.filter(F.map_entries("params"), lambda p: p["value"]["required"] & ~F.exists(entries, lambda a: a["key"] == p["key"])), lambda p: F.concat(F.lit("missing:"), p["key"]))

    def trouble(a: Column) -> Column:
        rule = F.try_element_at("params", a["key"])
        named = F.coalesce(F.try_variant_get(a["value"], "$['$result']", "string"), F.lit("")) != ""
        return F.when(rule.isNull(), F.concat(F.lit("unknown:"), a["key"])).when(~named & ~_admitted(rule["type"], F.schema_of_variant(a["value"])), F.concat(F.lit("type:"), a["key"]))

    wrong = F.filter(F.transform(entries, trouble), lambda x: x.isNotNull())
    none = F.when(F.col("tool").isNull(), F.array(F.lit("tool"))).when(args.isNull(), F.array(F.lit("arguments")))
    return given.withColumn("problems", F.coalesce(none, F.array_sort(F.concat(missing, wrong)))).drop("tool", "params")


def _parsed(messages: DataFrame) -> DataFrame:
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    rows = rows.withColumn("mid", F.xxhash64("conv_id", "turn", "role", "text"))
    body = F.when(F.col("role").isin("assistant", "tool") & F.col("text").startswith("{"), F.try_parse_json("text"))
    rows = rows.withColumn("body", body)
    calls = F.try_variant_get("body", "$.tool_calls", f"array<{CALL}>")
    rows = rows.withColumn("calls", F.when(F.col("role") == "assistant", F.when(F.size(calls) > 0, calls)))
    rows = rows.withColumn("result_of", F.when(F.col("role") == "tool", F.try_variant_get("body", "$.tool_call_id", "string")))
    linked = F.col("calls").isNotNull() | F.col("result_of").isNotNull()
    return rows.withColumn("content", F.when(linked, F.try_variant_get("body", "$.content", "string")).otherwise(F.col("text"))).drop("body")


def _order(parsed: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, mid, at, depth) of messages that depend on others or are needed: links (conv_id, mid, needs) settled wave by wave.

    at: the turn that the message stands at, its own or a later one; depth: its
    place among those moved to that turn. What waits on itself is never settled
    and keeps its turn. A wave reads the messages settled by the one before and
    the links that are still open, and writes what is left of these.
    """
    key = ["conv_id", "mid"]
    nodes = parsed.select(*key, "turn").distinct()
    place = "struct<at:bigint,depth:bigint>"
    edges = scratch.save(links.join(nodes.withColumnRenamed("turn", "own"), key).withColumn("found", F.lit(None).cast(place)).withColumn("ready", F.lit(False)), "open0")
    first = nodes.join(links.select(*key).distinct(), key, "left_anti").join(links.select("conv_id", F.col("needs").alias("mid")).distinct(), key, "left_semi")
    now = scratch.save(first.select(*key, F.col("turn").alias("at"), F.lit(0).cast("long").alias("depth")), "wave0")
    waves, wave = [now], 0
    while now.limit(1).count():
        wave += 1
        settled = now.select("conv_id", F.col("mid").alias("needs"), F.struct("at", "depth").alias("new"))
        step = edges.filter("not ready").join(settled, ["conv_id", "needs"], "left").withColumn("found", F.coalesce("found", "new")).drop("new")
        step = step.withColumn("ready", F.min(F.col("found").isNotNull()).over(Window.partitionBy(*key)))
        edges = scratch.save(step.select(*key, "needs", "own", "found", "ready"), f"open{wave}")
        done = edges.filter("ready").groupBy(*key, "own").agg(F.max("found").alias("last"))
        moved = F.col("own") <= F.col("last.at")
        done = done.select(*key, F.when(moved, F.col("last.at")).otherwise(F.col("own")).alias("at"), F.when(moved, F.col("last.depth") + 1).otherwise(F.lit(0)).cast("long").alias("depth"))
        now = scratch.save(done, f"wave{wave}")
        scratch.drop(f"open{wave - 1}")
        waves.append(now)
        if len(waves) > WAVES:  # so that the plan of a long chain stays small
            waves = [scratch.save(reduce(DataFrame.unionByName, waves), f"settled{wave}")]
    return reduce(DataFrame.unionByName, waves)


def format_chat(messages: DataFrame, schemas: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per message: conv_id, turn, role, at, depth, message_json, n_calls, n_linked, problems, orphan.

    Order a conversation by (at, depth, turn). n_linked: calls that have a
    result. orphan: a result whose call is missing, or that isn't the first of
    its call. Of calls with the same identifier the earliest counts. A call without
    one stays in its message and links with nothing: its problems are 'missing:id'
    and those of its arguments, without an identifier before them. Text that
    isn't a JSON object of the forms above, broken JSON included, is content;
    null text has none. Equal rows get equal results; rows without conv_id link
    with nothing. Extra columns are ignored.
    """
    parsed = scratch.save(_parsed(messages), "parsed")
    calls = parsed.filter("calls is not null").select("conv_id", "turn", "mid", F.posexplode("calls").alias("nth", "call"))
    calls = calls.select("conv_id", "turn", "mid", "nth", "call.*").dropDuplicates(["conv_id", "mid", "nth"])
    calls = argument_problems(calls, schemas).withColumn("problems", F.when(F.col("id").isNull(), F.concat(F.array(F.lit("missing:id")), "problems")).otherwise(F.col("problems")))
    calls = scratch.save(calls, "calls")
    first_call = calls.filter("id is not null").groupBy("conv_id", F.col("id").alias("result_of")).agg(F.min_by("mid", F.struct("turn", "mid")).alias("call_mid"))
    results = parsed.filter("result_of is not null").select("conv_id", "turn", "mid", "result_of").distinct()
    linked = results.join(first_call, ["conv_id", "result_of"])
    first_result = linked.groupBy("conv_id", "result_of", "call_mid").agg(F.min_by("mid", F.struct("turn", "mid")).alias("result_mid"))
    first_result = scratch.save(first_result, "links")

    names = F.array_distinct(F.regexp_extract_all(F.to_json("arguments"), F.lit(r'\{"\$result":"([^"\\]+)"\}'), F.lit(1)))
    named = calls.select("conv_id", "mid", F.explode(names).alias("result_of")).join(first_result, ["conv_id", "result_of"])
    links = named.select("conv_id", "mid", F.col("result_mid").alias("needs")).unionByName(linked.select("conv_id", "mid", F.col("call_mid").alias("needs"))).filter("mid != needs").distinct()
    links = scratch.save(links, "needs")
    placed = _order(parsed, links, scratch)

    # A hash names a message inside its conversation only.
    key = ["conv_id", "mid"]
    answered = calls.join(first_result.select("conv_id", F.col("result_of").alias("id"), F.col("call_mid").alias("mid"), "result_mid"), ["conv_id", "id", "mid"], "left")
    answered = answered.groupBy(F.col("conv_id").alias("_conv"), F.col("mid").alias("_mid")).agg(F.count("result_mid").alias("n_linked"), F.array_sort(F.flatten(F.collect_list(F.transform("problems", lambda p: F.concat_ws(":", F.col("id"), p))))).alias("problems"))
    out = parsed.join(placed, key, "left").join(answered, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("mid") == F.col("_mid")), "left")
    out = out.join(first_result.select("conv_id", F.col("result_mid").alias("mid"), F.lit(True).alias("first")).distinct(), key, "left")
    ordered = F.transform("calls", lambda c: F.struct(c["arguments"].alias("arguments"), c["id"].alias("id"), c["name"].alias("name")))
    line = F.to_json(F.struct("content", "role", F.col("result_of").alias("tool_call_id"), ordered.alias("tool_calls")))
    return out.select(
        "conv_id", "turn", "role", F.coalesce("at", "turn").alias("at"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), line.alias("message_json"),
        F.coalesce(F.size("calls"), F.lit(0)).cast("long").alias("n_calls"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("problems", F.array().cast("array<string>")).alias("problems"), (F.col("result_of").isNotNull() & F.col("first").isNull()).alias("orphan"),
    )
