"""Chat formatting with tool-call linking. DataFrame functions only.

Input: a row for each event of a conversation: conv_id, turn, role, text, and for tool use call_id, name and arguments
(a JSON object as text). An event with a name is a call, one of role ``tool`` a result. A value "$<call_id>" in the
arguments refers to the result of that call.

1. Linking: calls and results are joined by (conv_id, call_id). The first call of an id (by turn) is the call and the
   first result its result; further ones are ``duplicate``, a result without a call is ``orphan``, a call without a
   result ``pending``.
2. Topological order: a result comes after its call, a call after the results it refers to. Levels (the longest chain
   before an event) are found round by round: open links meet the events placed in the last round, are counted off, and an
   event without open links is placed. ``due`` is the
   event's own turn, or that of the latest event it depends on if that is later. Events are placed by (due, level,
   turn); those on or behind a cycle are ``cyclic`` and stand at their own turn. Places are dealt by a skew-safe numbering.
3. Validation: arguments against the tool's schema (tools: name, param, type, required): unknown tool or parameter, wrong
   type, missing parameter, no JSON object, or a reference to a call that the conversation does not have. References are
   resolved first; one that is has the type that is asked for.
4. Serialisation: one line of canonical JSON for each event: keys in alphabetical order also inside the arguments, no
   spaces, absent values left out.

Events are never gathered by conversation, role or tool, so none of them can be hot.

Defined cases: exact copies of an event count as one (``copies``); a null conv_id is a conversation of its own; null turns
come last; null and empty texts differ (absent or ""); a call without an id is pending; without tools, all are unknown; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvest.llm._text import cut
from harvest.operators.numbering import consecutive_index

EVENT = ["conv_id", "turn", "role", "text", "call_id", "name", "arguments"]
LAST = (1 << 63) - 1
#: The types of a JSON schema, and what Spark names the types of the values that fit them.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DECIMAL|DOUBLE", "boolean": "BOOLEAN", "object": "OBJECT", "array": "ARRAY"}


def checked(events: DataFrame, tools: DataFrame) -> DataFrame:
    """The events with their arguments as a variant (``args``), the ids they refer to and the errors of calls."""
    spec = tools.groupBy(F.col("name").alias("tool")).agg(F.map_from_entries(F.collect_set(F.struct("param", F.struct("type", "required")))).alias("spec"))
    rows = events.withColumn("args", F.try_parse_json("arguments")).withColumn("given", F.expr("try_variant_get(args, '$', 'map<string,variant>')"))
    rows = rows.join(spec, F.col("name") == F.col("tool"), "left")
    fits = " ".join(f"WHEN '{k}' THEN '^({v})'" for k, v in TYPES.items())
    found = rows.select("event", *EVENT, "copies", "args", F.expr("""
        transform(filter(map_entries(given), e -> startswith(coalesce(try_variant_get(e.value, '$', 'string'), ''), '$')),
                  e -> struct(e.key AS param, substring(try_variant_get(e.value, '$', 'string'), 2) AS ref))""").alias("asks"), F.expr(f"""
        CASE WHEN name IS NULL THEN NULL
             WHEN tool IS NULL THEN array('unknown tool')
             WHEN given IS NULL THEN array('not an object')
             ELSE concat(
               transform(filter(map_entries(given), e -> spec[e.key] IS NULL), e -> concat('unknown ', e.key)),
               transform(filter(map_entries(given), e -> spec[e.key] IS NOT NULL
                           AND NOT startswith(coalesce(try_variant_get(e.value, '$', 'string'), ''), '$')
                           AND NOT rlike(schema_of_variant(e.value), CASE spec[e.key].type {fits} ELSE '' END)), e -> concat('type ', e.key)),
               transform(filter(map_entries(spec), e -> e.value.required AND NOT coalesce(array_contains(map_keys(given), e.key), false)),
                         e -> concat('missing ', e.key))) END""").alias("errors"))
    asked = found.where("name IS NOT NULL AND size(asks) > 0").select("event", "conv_id", F.explode("asks").alias("a")).select("event", "conv_id", "a.param", "a.ref")
    calls = found.where("name IS NOT NULL AND call_id IS NOT NULL").select(F.col("conv_id").alias("cconv"), F.col("call_id").alias("ccall")).distinct()
    lost = (asked.join(calls, F.expr("conv_id <=> cconv AND ref = ccall"), "left_anti").groupBy(F.col("event").alias("losing"))
            .agg(F.collect_set(F.concat(F.lit("unresolved "), "param")).alias("lost")))        # no more than the call has parameters
    return found.join(lost, F.col("event") == F.col("losing"), "left").select(
        "event", *EVENT, "copies", "args", F.expr("array_distinct(asks.ref)").alias("refers"), F.expr("array_sort(concat(errors, coalesce(lost, array())))").alias("errors"))


def linked(events: DataFrame) -> DataFrame:
    """events with ``status`` and the event that each depends on by identifier (``answers``, for results)."""
    at = F.coalesce("turn", F.lit(LAST))
    key = events.where("call_id is not null")
    first_call = key.where("name is not null").groupBy("conv_id", "call_id").agg(F.min_by("event", F.struct(at, "event")).alias("call"))
    first_result = key.where("name is null and role = 'tool'").groupBy("conv_id", "call_id").agg(F.min_by("event", F.struct(at, "event")).alias("result"))
    links = first_call.alias("c").join(first_result.alias("r"), F.expr("c.conv_id <=> r.conv_id and c.call_id = r.call_id"), "full").select(
        F.coalesce("c.conv_id", "r.conv_id").alias("lconv"), F.coalesce("c.call_id", "r.call_id").alias("lcall"), "call", "result")
    rows = events.join(links, F.expr("conv_id <=> lconv and call_id = lcall"), "left")
    return rows.withColumn("status", F.expr("""
        CASE WHEN name IS NOT NULL THEN CASE WHEN call_id IS NULL THEN 'pending' WHEN call <> event THEN 'duplicate' WHEN result IS NULL THEN 'pending' ELSE 'call' END
             WHEN role = 'tool' THEN CASE WHEN call IS NULL THEN 'orphan' WHEN result <> event THEN 'duplicate' ELSE 'result' END
             ELSE 'message' END""")).withColumn("answers", F.expr("if(status = 'result', call, NULL)")).drop("lconv", "lcall", "call")


def dependencies(rows: DataFrame) -> DataFrame:
    """event, needs: each link that the order must respect."""
    answers = rows.where("answers is not null").select("event", F.col("answers").alias("needs"))
    refers = rows.where("name is not null").select("event", "conv_id", F.explode("refers").alias("ref"))
    results = rows.where("status = 'result'").select(F.col("conv_id").alias("rconv"), F.col("call_id").alias("rcall"), F.col("event").alias("needs"))
    return answers.union(refers.join(results, F.expr("conv_id <=> rconv and ref = rcall")).select("event", "needs")).distinct()


def levels(rows: DataFrame) -> DataFrame:
    """event, level, due of all events that depend on others, or others on them; those on or behind a cycle have neither."""
    turns = rows.select("event", F.coalesce("turn", F.lit(LAST)).alias("turn"))
    links = cut(dependencies(rows))
    depending = links.groupBy("event").agg(F.count(F.lit(1)).alias("n")).join(turns, "event").select(
        "event", "n", "turn", F.lit(-1).alias("l"), F.lit(None).cast("long").alias("d"))
    open_ = cut(depending)
    new = cut(links.select(F.col("needs").alias("event")).distinct().join(links.select("event"), "event", "left_anti").join(turns, "event")
              .select("event", F.lit(0).alias("level"), F.col("turn").alias("due")))
    placed, left = new, links
    while not open_.isEmpty() and not new.isEmpty():
        last = new.select(F.col("event").alias("needs"), F.col("level").alias("nlevel"), F.col("due").alias("ndue"))
        met = left.join(last, "needs").groupBy("event").agg(F.count(F.lit(1)).alias("k"), F.max("nlevel").alias("ml"), F.max("ndue").alias("md"))
        state = cut(open_.join(met, "event", "left").select("event", (F.col("n") - F.coalesce("k", F.lit(0))).alias("n"), "turn", F.greatest("l", "ml").alias("l"), F.greatest("d", "md").alias("d")))
        left = cut(left.join(last.select("needs"), "needs", "left_anti").select("event", "needs"))
        new, open_ = state.where("n = 0").select("event", (F.col("l") + 1).alias("level"), F.greatest("d", "turn").alias("due")), state.where("n > 0")
        placed = placed.union(new)
    return links.select("event").distinct().join(placed, "event", "left")


def format_chat(events: DataFrame, tools: DataFrame) -> DataFrame:
    """conv_id, place, turn, role, call_id, status, level, errors, copies and json: a row for each distinct event."""
    rows = events.groupBy(*EVENT).agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("event", F.md5(F.to_json(F.struct(*EVENT))))
    rows = cut(linked(checked(rows, tools)).withColumn("canonical", F.to_json("args")).drop("args"))
    deps = levels(rows).withColumnRenamed("event", "depending")
    rows = rows.join(deps, F.col("event") == F.col("depending"), "left").withColumn(
        "status", F.expr("if(depending is not null and level is null, 'cyclic', status)")).withColumns({
            "due": F.coalesce("due", "turn", F.lit(LAST)), "level": F.expr("if(status = 'cyclic', null, coalesce(level, 0))")})
    line = F.to_json(F.struct(F.try_parse_json("canonical").alias("arguments"), "call_id", "errors", "name", "role", "status", "text", "turn"))
    rows = rows.select("event", "conv_id", "due", "level", "turn", "role", "call_id", "status", "errors", "copies", line.alias("json"))
    placed = consecutive_index(rows, ["due", F.coalesce("level", F.lit(0)), F.coalesce("turn", F.lit(LAST)), "event"], ["conv_id"], name="place")
    return placed.select("conv_id", "place", "turn", "role", "call_id", "status", "level", "errors", "copies", "json")


def tool_table(spark: SparkSession) -> DataFrame:
    """The schemas of the tools that ``tool_use`` calls."""
    return spark.sql("""
        SELECT * FROM VALUES ('lookup', 'query', 'string', true), ('lookup', 'limit', 'integer', false), ('lookup', 'after', 'string', false),
                             ('measure', 'length', 'number', true), ('measure', 'unit', 'string', true) AS t(name, param, type, required)""")


def tool_use(conversations: DataFrame) -> DataFrame:
    """Events with tool use, derived from every row of the table: before each assistant turn stand a call and its
    result, in any order; some calls refer to an earlier result, some arguments do not fit, some results have no call."""
    length = F.length("text")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", length.alias("len"))
    empty = F.lit(None).cast("string")
    messages = rows.select("conv_id", (F.col("turn") * 10).alias("turn"), "role", "text", empty.alias("call_id"), empty.alias("name"), empty.alias("arguments"))
    used = rows.where("role = 'assistant'").withColumn("tool", F.expr("if(len % 3 = 0, 'measure', 'lookup')"))
    calls = used.select("conv_id", (F.col("turn") * 10 - 4).alias("turn"), "role", empty.alias("text"), F.expr("concat('c', turn)").alias("call_id"), F.col("tool").alias("name"), F.expr("""
        CASE WHEN len % 11 = 0 THEN 'none'
             WHEN tool = 'measure' AND len % 7 = 0 THEN concat('{"length":"', len, '"}')
             WHEN tool = 'measure' THEN concat('{"unit": "chars", "length": ', len, '}')
             WHEN turn % 4 = 3 THEN concat('{"query":"', turn, '", "limit": ', len % 10, ', "after": "$c', turn - 2, '"}')
             ELSE concat('{"query":"', turn, '", "limit": ', len % 10, '.5}') END""").alias("arguments"))
    results = used.select("conv_id", F.expr("if(len % 2 = 0, turn * 10 - 2, turn * 10 - 6)").alias("turn"), F.lit("tool").alias("role"), F.col("text"),
                          F.expr("if(len % 13 = 0, concat('x', turn), concat('c', turn))").alias("call_id"), empty.alias("name"), empty.alias("arguments"))
    return messages.union(calls).union(results)
