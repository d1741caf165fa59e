"""Chat formatting: tool calls linked with their results, ordered, validated and written as canonical JSON.

Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, plain, shared_dir

CALLS = "tool_calls array<struct<id string, name string, arguments string, after array<string>>>"


#: Calls of one conversation that are gathered at a time.
GATHERED = 500


def _depths(calls: DataFrame) -> DataFrame:
    """conv_id, id, depth: the longest chain of earlier calls that a call comes after.

    Calls only come after those of earlier turns, so one fold in the order of turns gives the depths of a conversation. It
    runs over GATHERED calls at a time: a longer conversation takes a round for each piece, and what a piece needs of those
    before it is joined to it. Each round writes its own calls only. Calls are numbered by spans of turns, so that no task
    has to sort one conversation whole.
    """
    spark = calls.sparkSession
    folder = f"{shared_dir(spark)}/depths-{uuid.uuid4().hex}"
    ids = calls.groupBy("conv_id", "id").agg(F.min("turn").alias("turn"))
    ids = cut(ids.withColumn("span", F.floor(F.col("turn") / 64)))
    before = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    shift = ids.groupBy("conv_id", "span").count().select("conv_id", "span", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    place = F.row_number().over(Window.partitionBy("conv_id", "span").orderBy("turn", "id"))
    ids = cut(ids.withColumn("place", place).join(shift, ["conv_id", "span"]).select("conv_id", "id", "turn", F.floor((F.col("shift") + F.col("place") - 1) / GATHERED).alias("piece")))
    wanted = calls.select("conv_id", "id", F.explode("after").alias("before")).distinct().join(ids, ["conv_id", "id"])
    known = ids.select("conv_id", F.col("id").alias("before"), F.col("turn").alias("then"), F.col("piece").alias("of"))
    edges = cut(wanted.join(known, ["conv_id", "before"]).filter("then < turn").select("conv_id", "id", "before", "piece", "of"))
    near = edges.filter("of = piece").groupBy("conv_id", "id").agg(F.collect_list("before").alias("near"))
    last = ids.agg(F.max("piece")).first()[0] or 0
    done: DataFrame | None = None
    for k in range(last + 1):
        part = ids.filter(F.col("piece") == k).join(near, ["conv_id", "id"], "left")
        base = F.lit(0)
        if done is not None:
            far = edges.filter((F.col("piece") == k) & (F.col("of") < k)).join(done.withColumnRenamed("id", "before"), ["conv_id", "before"])
            part = part.join(far.groupBy("conv_id", "id").agg((F.max("depth") + 1).alias("far")), ["conv_id", "id"], "left")
            base = F.coalesce(F.col("far"), F.lit(0))
        item = F.struct("turn", "id", base.alias("base"), F.coalesce("near", F.array().cast("array<string>")).alias("near"))
        rows = part.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
        fold = """aggregate(items, cast(map() AS map<string, int>), (m, x) ->
            map_concat(m, map(x.id, greatest(x.base, coalesce(array_max(transform(x.near, b -> try_element_at(m, b) + 1)), 0)))))"""
        new = rows.select("conv_id", F.explode(F.expr(fold)).alias("id", "depth"))
        new.write.parquet(f"{folder}/piece={k}")
        done = spark.read.schema(new.schema).parquet(*[f"{folder}/piece={j}" for j in range(k + 1)])
    return done


def link_tool_calls(messages: DataFrame, tools: DataFrame) -> DataFrame:
    """Link every tool call with its result.

    messages: conv_id, turn, role, text. An assistant's text may be JSON with tool_calls (id, name, arguments, after: ids of
    calls whose results it uses); a tool's text is JSON with tool_call_id and content. tools: name, parameter, kind
    (string, integer, number, boolean, object, array), required.

    Returns a row for each call: conv_id, turn, call_id, tool, depth (its topological generation: calls of a smaller depth
    come first), result_turn (null if none came), valid, problems (sorted, joined by '; ') and canonical (one JSON object with
    sorted keys and no white space).
    A result answers the calls of its identifier in its conversation; of several the earliest turn, then the smallest
    content. A call that comes after an unknown call, or one not made in an earlier turn, has a problem and that order is
    ignored, so there are no cycles; an id that repeats has the depth of its first turn. Null roles, texts that are null, empty or no JSON of this form, and calls without id
    are no calls; a null conv_id joins nothing. Calls that repeat an id each give a row. Empty tables give no rows.
    Extra columns are not read.
    """
    m = plain(messages, conv_id="long", turn="long", role="string", text="string")
    calls = m.filter("role = 'assistant'").select("conv_id", "turn", F.explode(F.from_json("text", CALLS)["tool_calls"]).alias("c"))
    calls = calls.select("conv_id", "turn", "c.id", "c.name", "c.arguments", F.coalesce("c.after", F.array().cast("array<string>")).alias("after")).filter("id IS NOT NULL")
    results = m.filter("role = 'tool'").select("conv_id", "turn", F.from_json("text", "tool_call_id string, content string").alias("r")).filter("r.tool_call_id IS NOT NULL")
    results = results.groupBy("conv_id", F.col("r.tool_call_id").alias("id")).agg(F.min(F.struct("turn", "r.content")).alias("result"))
    specs = plain(tools, name="string", parameter="string", kind="string", required="boolean").groupBy("name").agg(F.array_sort(F.collect_set(F.struct("parameter", "kind", "required"))).alias("spec"))
    calls = calls.withColumn("args", F.expr("try_parse_json(arguments)")).withColumn("given", F.expr("try_cast(args AS map<string, variant>)"))
    calls = calls.join(specs, "name", "left")
    kinds = F.expr("""transform(map_entries(given), e -> struct(e.key AS key, CASE
        WHEN schema_of_variant(e.value) = 'STRING' THEN 'string' WHEN schema_of_variant(e.value) = 'BIGINT' THEN 'integer'
        WHEN schema_of_variant(e.value) = 'BOOLEAN' THEN 'boolean' WHEN schema_of_variant(e.value) LIKE 'OBJECT%' THEN 'object'
        WHEN schema_of_variant(e.value) LIKE 'ARRAY%' THEN 'array' WHEN schema_of_variant(e.value) = 'VOID' THEN 'null' ELSE 'number' END AS kind))""")
    calls = calls.withColumn("kinds", F.map_from_entries(kinds)).drop("given", "arguments")
    problems = F.expr("""CASE WHEN spec IS NULL THEN array('unknown tool') WHEN kinds IS NULL THEN array('arguments are no object')
        ELSE concat(
            transform(filter(spec, p -> p.required AND NOT map_contains_key(kinds, p.parameter)), p -> concat('missing ', p.parameter)),
            transform(filter(spec, p -> map_contains_key(kinds, p.parameter) AND kinds[p.parameter] <> p.kind AND NOT (p.kind = 'number' AND kinds[p.parameter] = 'integer')), p -> concat(p.parameter, ' is no ', p.kind)),
            transform(array_except(map_keys(kinds), transform(spec, p -> p.parameter)), k -> concat('unexpected ', k))) END""")
    calls = cut(calls.withColumn("problems", problems).select("conv_id", "turn", "id", "name", "args", "after", "problems"))
    early = calls.groupBy("conv_id", F.col("id").alias("before")).agg(F.min("turn").alias("then"))
    wrong = calls.select("conv_id", "turn", "id", F.explode("after").alias("before")).join(early, ["conv_id", "before"], "left").filter("then IS NULL OR then >= turn")
    wrong = wrong.groupBy("conv_id", "turn", "id").agg(F.collect_set(F.concat(F.lit("not after "), F.col("before"))).alias("late"))
    out = calls.join(results, ["conv_id", "id"], "left").join(_depths(calls), ["conv_id", "id"], "left").join(wrong, ["conv_id", "turn", "id"], "left")
    found = F.array_sort(F.concat("problems", F.coalesce("late", F.array().cast("array<string>"))))
    canonical = F.to_json(F.struct(F.col("args").alias("arguments"), F.col("id"), F.col("name"), F.col("result.content").alias("result")))
    return out.select("conv_id", "turn", F.col("id").alias("call_id"), F.col("name").alias("tool"), F.coalesce(F.col("depth"), F.lit(0)).cast("long").alias("depth"), F.col("result.turn").alias("result_turn"), (F.size(found) == 0).alias("valid"), F.array_join(found, "; ").alias("problems"), canonical.alias("canonical"))


TOOLS = [("search", "query", "string", True), ("search", "limit", "integer", False), ("lookup", "key", "string", True), ("lookup", "exact", "boolean", True)]


def tool_log(conversations: DataFrame) -> DataFrame:
    """A log of tool messages drawn from chats: each user turn becomes an assistant's call, each assistant turn its result.

    By conv_id modulo 4 the tool is search, lookup, lookup without a needed argument, or one that no schema names. A call comes
    after that of the user turn two before, if there is one. Other roles keep their text.
    """
    ident = lambda back: F.concat("conv_id", F.lit("-"), F.col("turn") - back)
    arguments = F.expr("""CASE WHEN conv_id % 4 = 0 THEN to_json(named_struct('query', text, 'limit', turn + 1))
        WHEN conv_id % 4 = 1 THEN to_json(named_struct('key', text, 'exact', turn = 0)) ELSE to_json(named_struct('key', text)) END""")
    name = F.expr("CASE conv_id % 4 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' WHEN 2 THEN 'lookup' ELSE 'guess' END")
    after = F.when(F.col("turn") >= 2, F.array(ident(2))).otherwise(F.array().cast("array<string>"))
    call = F.to_json(F.struct(F.array(F.struct(ident(0).alias("id"), name.alias("name"), F.expr("parse_json(arguments)").alias("arguments"), after.alias("after"))).alias("tool_calls")))
    result = F.to_json(F.struct(ident(1).alias("tool_call_id"), F.col("text").alias("content")))
    c = plain(conversations, conv_id="long", turn="long", role="string", text="string").withColumn("arguments", arguments)
    return c.select("conv_id", "turn", F.expr("CASE role WHEN 'user' THEN 'assistant' WHEN 'assistant' THEN 'tool' ELSE role END").alias("role"), F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text")).alias("text"))


def op3_tool_calls(conversations: DataFrame) -> DataFrame:
    tools = conversations.sparkSession.createDataFrame(TOOLS, "name string, parameter string, kind string, required boolean")
    return link_tool_calls(tool_log(conversations), tools)


SQL = r"""
WITH c AS (SELECT conv_id, turn, conv_id || '-' || turn AS id, text, conv_id % 4 AS k FROM conversations WHERE role = 'user'),
r AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
u AS (SELECT c.*, r.turn AS result_turn, r.text AS content, p.conv_id IS NULL AND c.turn >= 2 AS lost, c.conv_id || '-' || (c.turn - 2) AS before
  FROM c LEFT JOIN r ON r.conv_id = c.conv_id AND r.turn = c.turn + 1 LEFT JOIN c p ON p.conv_id = c.conv_id AND p.turn = c.turn - 2),
g AS (SELECT *, sum(CASE WHEN lost OR turn < 2 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain FROM u),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, chain ORDER BY turn) - 1 AS depth FROM g),
f AS (SELECT *, list_sort(list_concat(CASE k WHEN 2 THEN ['missing exact'] WHEN 3 THEN ['unknown tool'] ELSE [] END, CASE WHEN lost THEN ['not after ' || before] ELSE [] END)) AS found FROM e)
SELECT conv_id, turn, id AS call_id, CASE k WHEN 0 THEN 'search' WHEN 3 THEN 'guess' ELSE 'lookup' END AS tool, CAST(depth AS BIGINT) AS depth, result_turn,
  len(found) = 0 AS valid, array_to_string(found, '; ') AS problems,
  '{"arguments":' || CASE k WHEN 0 THEN '{"limit":' || (turn + 1) || ',"query":' || to_json(text) || '}' WHEN 1 THEN '{"exact":' || (turn = 0) || ',"key":' || to_json(text) || '}' ELSE '{"key":' || to_json(text) || '}' END
  || ',"id":"' || id || '","name":"' || CASE k WHEN 0 THEN 'search' WHEN 3 THEN 'guess' ELSE 'lookup' END || '"' || CASE WHEN content IS NULL THEN '' ELSE ',"result":' || to_json(content) END || '}' AS canonical
FROM f
"""
