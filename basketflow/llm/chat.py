"""Tool calls in conversations: linked, ordered, validated, written as canonical JSON.

DataFrame functions only. A call has an identifier, a tool's name, arguments as JSON text and
perhaps the identifiers of the calls whose results it builds on (``after``, a text or an array); a
result names the call it answers. Calls and results meet in a hash join on the identifier. A call's
depth is the length of the longest way to it over calls it builds on: sorted by depth, every call
stands behind those. No step needs a conversation in one task.

No row is lost. Equal rows of one identifier are copies, counted in ``rows``. Of different ones the
least links, and each other one is a record of its own, with the status ``conflict``.
"""

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.llm.tables import keep

#: Arguments of each tool: name -> (JSON type, required).
Schema = dict[str, tuple[str, bool]]

TYPES = {
    "string": ["STRING"],
    "integer": ["BIGINT"],
    "number": ["BIGINT", "DOUBLE", "DECIMAL"],
    "boolean": ["BOOLEAN"],
    "object": ["OBJECT"],
    "array": ["ARRAY"],
}

# Linking


def left_join(df: DataFrame, other: DataFrame, key: str, to: str) -> DataFrame:
    """A left join; rows without a key stay where they are instead of meeting in one task."""
    known = df.where(F.col(key).isNotNull()).join(other, F.col(key) == F.col(to), "left")
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in other.dtypes]
    return known.unionByName(df.where(F.col(key).isNull()).select("*", *nothing))


def variants(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The different rows of each ``call_id`` with their ``copies``.

    ``first`` marks the least by ``columns``; ``conflict`` tells whether there are others.
    """
    different = keep(rows.groupBy("call_id", *columns).agg(F.count("*").alias("copies")), "variants")
    least = different.groupBy("call_id").agg(F.min(F.struct(*columns)).alias("_least"), (F.count("*") > 1).alias("conflict"))
    first = F.struct(*columns).eqNullSafe(F.col("_least"))
    return different.join(least, "call_id").select("call_id", *columns, "copies", "conflict", first.alias("first"))


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """``calls(call_id, name, arguments, after)`` with the ``output`` of ``results(call_id, output)``.

    ``status`` is ``answered``, ``unanswered``, ``orphan`` for a result without a call, or
    ``conflict`` for a row that differs from the one that counts for its identifier, which is the
    least; that one's ``conflict`` is true then. ``is_call`` tells calls from results. ``rows``
    adds up to the rows of both tables. A third column of ``results``, ``part``, marks rows that are
    part of a call's arguments already: equal ones count in the rows of the call, others of that
    identifier are conflicts. Rows without an identifier link to nothing; each stays, as
    ``unanswered`` or ``orphan``.
    """
    none = F.lit(None).cast("string")
    nowhere = F.lit(None).cast(calls.schema["after"].dataType).alias("after")
    results = results if "part" in results.columns else results.withColumn("part", F.lit(False))
    named = variants(calls.where("call_id IS NOT NULL"), ["name", "arguments", "after"])
    answers, parts = (
        variants(results.where(F.col("call_id").isNotNull() & (F.col("part") == part)), ["output"]) for part in (False, True)
    )
    left = named.where("first").select(
        "call_id", "name", "arguments", "after", F.col("copies").alias("call_copies"), F.col("conflict").alias("call_conflict"), F.lit(True).alias("called")
    )
    right = answers.where("first").select(
        "call_id", "output", F.col("copies").alias("result_copies"), F.col("conflict").alias("result_conflict"), F.lit(True).alias("answered")
    )
    inside = parts.where("first").select(F.col("call_id").alias("_id"), F.col("copies").alias("part_copies"), F.col("conflict").alias("part_conflict"))
    linked = left_join(left, inside, "call_id", "_id").drop("_id").join(right.hint("shuffle_hash"), "call_id", "full_outer")
    status = F.when(F.col("called").isNull(), "orphan").when(F.col("answered").isNull(), "unanswered").otherwise("answered")
    copies = [F.coalesce(f"{kind}_copies", F.lit(0)) for kind in ("call", "result", "part")]
    conflicts = [F.coalesce(f"{kind}_conflict", F.lit(False)) for kind in ("call", "result", "part")]
    found = linked.select(
        "call_id", "name", "arguments", "after", "output", status.alias("status"), F.coalesce("called", F.lit(False)).alias("is_call"),
        (copies[0] + copies[1] + copies[2]).alias("rows"), (conflicts[0] | conflicts[1] | conflicts[2]).alias("conflict"),
    )
    tell = lambda status, is_call: [F.lit(status).alias("status"), F.lit(is_call).alias("is_call")]
    one = [F.lit(1).cast("long").alias("rows"), F.lit(False).alias("conflict")]
    more = [F.col("copies").alias("rows"), F.lit(True).alias("conflict")]
    empty = [none.alias("name"), none.alias("arguments"), nowhere]
    others = [
        named.where("NOT first").select("call_id", "name", "arguments", "after", none.alias("output"), *tell("conflict", True), *more),
        answers.where("NOT first").select("call_id", *empty, "output", *tell("conflict", False), *more),
        parts.where("NOT first").select("call_id", *empty, "output", *tell("conflict", False), *more),
        calls.where("call_id IS NULL").select("call_id", "name", "arguments", "after", none.alias("output"), *tell("unanswered", True), *one),
        results.where("call_id IS NULL").select("call_id", *empty, "output", *tell("orphan", False), *one),
    ]
    for other in others:
        found = found.unionByName(other)
    return found


# Order


def depths(calls: DataFrame) -> DataFrame:
    """``(call_id, depth)`` of ``calls(call_id, after)`` with distinct identifiers.

    A call that builds on nothing, or on calls that are not there, has depth 0, else one more than
    the deepest call it builds on. Calls that build on one another in a circle, and those that
    build on them, have no depth (null).

    A call is a set of conditions ``(to, add)``: at least ``add`` deeper than ``to``, or than
    nothing. Each round replaces a condition on a call whose depth is known, or that has a single
    condition itself, by what that says. So chains shorten by half each time, also where ways
    part and meet again; only calls that build on several calls each, layer upon layer, take a round
    per layer. As long as any call can still get a depth, a round gives one to some call.
    """
    after = F.col("after") if calls.schema["after"].dataType.typeName() == "array" else F.array("after")
    there = calls.select(F.col("call_id").alias("_there"))
    asked = calls.select("call_id", F.explode_outer(after).alias("asked"))
    rows = left_join(asked, there, "asked", "_there")
    open_ = F.col("to").isNotNull()
    rows = rows.select(
        "call_id", F.col("_there").alias("to"), F.when(F.col("_there").isNull(), 0).otherwise(1).cast("long").alias("add")
    )
    rows = keep(rows.groupBy("call_id", "to").agg(F.max("add").alias("add")), "conditions")
    known = -1
    while True:
        calls_now = rows.groupBy("call_id").agg(
            F.count("to").alias("n_open"),
            F.max(F.when(~open_, F.col("add"))).alias("least"),
            F.max("to").alias("only"),
            F.max(F.when(open_, F.col("add"))).alias("only_add"),
        )
        calls_now = keep(calls_now, "calls")
        now = calls_now.where("n_open = 0").count()
        if now == known or not rows.where(open_).take(1):
            break
        known = now
        said = calls_now.where("n_open < 2").select(F.col("call_id").alias("_id"), "n_open", "least", "only", "only_add")
        met = left_join(rows, said, "to", "_id")
        nothing, none = F.lit(None).cast("string"), F.lit(None).cast("long")
        condition = lambda to, add: F.struct(to.alias("to"), add.cast("long").alias("add"))
        through = condition(F.when(F.col("n_open") == 1, F.col("only")), F.when(F.col("n_open") == 1, F.col("add") + F.col("only_add")))
        beyond = condition(nothing, F.when(F.col("_id").isNotNull(), F.col("add") + F.col("least")).otherwise(none))
        kept = condition(F.col("to"), F.when(F.col("_id").isNull(), F.col("add")))
        said_of = F.filter(F.array(through, beyond, kept), lambda c: c["add"].isNotNull())
        rows = met.select("call_id", F.inline(said_of)).groupBy("call_id", "to").agg(F.max("add").alias("add"))
        rows = keep(rows, "conditions")
    return calls_now.select("call_id", F.when(F.col("n_open") == 0, F.col("least")).alias("depth"))


# Arguments


def problems(name: Column, arguments: Column, tools: dict[str, Schema]) -> Column:
    """What is wrong with the arguments of a call, as an array of texts; empty if nothing is."""
    parsed = F.try_parse_json(arguments)
    whole = F.schema_of_variant(parsed)
    found = F.array(F.lit("unknown tool"))
    for tool, schema in tools.items():
        checks = [_field_problem(parsed, field, kind, required) for field, (kind, required) in schema.items()]
        known = F.array(*map(F.lit, schema)) if schema else F.array().cast("array<string>")
        extra = F.transform(F.array_except(F.json_object_keys(arguments), known), lambda k: F.concat(F.lit("unexpected "), k))
        own = F.concat(F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>"), extra)
        found = F.when(name == tool, own).otherwise(found)
    return F.when(parsed.isNull() | ~whole.startswith("OBJECT"), F.array(F.lit("not an object"))).otherwise(found)


def _field_problem(parsed: Column, field: str, kind: str, required: bool) -> Column:
    path = "$." + field if field.isidentifier() else f"$[{json.dumps(field)}]"
    value = F.try_variant_get(parsed, path, "variant")
    type_name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    missing = F.when(value.isNull(), F.lit(f"missing {field}")) if required else F.when(value.isNull(), F.lit(None))
    return missing.when(~type_name.isin(TYPES[kind]), F.lit(f"{field} is not of type {kind}"))


def canonical(arguments: Column) -> Column:
    """JSON text with sorted keys and no white space; null if it isn't JSON."""
    return F.to_json(F.try_parse_json(arguments))


# Conversations

#: What a user's turn asks of the assistant.
REPLY: dict[str, Schema] = {"reply": {"system": ("string", False), "text": ("string", True), "turn": ("integer", True)}}


def from_turns(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain turns ``(conv_id, turn, role, text)``.

    A user's turn calls ``reply``; its identifier is made of conversation and turn, and it builds
    on the user's turn before it, whatever stands in between. A system turn right before it goes
    into its arguments (``part``); of different ones the least. An assistant's turn is the result of
    the turn before it. Turns of other roles, or a system turn that no user's turn follows, answer
    nothing: they are results without a call. Other columns are not read, so they cannot clash.
    """
    at = lambda back: F.concat_ws(":", "conv_id", F.col("turn") - back)
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    turns = messages.select(
        "conv_id", "role", "text", "turn", *[F.when(known, at(back)).alias(f"id{back}") for back in (-1, 0, 1)]
    )
    users = turns.where("role = 'user'")
    system = turns.where("role = 'system'").select(F.col("id-1").alias("_id"), "text").where("_id IS NOT NULL")
    # A struct, since the least text may be none.
    systems = system.groupBy("_id").agg(F.min(F.struct("text")).alias("_system"))
    arguments = F.struct(F.col("_system.text").alias("system"), "text", "turn")
    before = _before(users.where("id0 IS NOT NULL").select("conv_id", "turn").distinct())
    before = before.select(F.concat_ws(":", "conv_id", "turn").alias("_call"), F.concat_ws(":", "conv_id", "before").alias("_after"), "before")
    asked = left_join(left_join(users, systems, "id0", "_id").drop("_id"), before, "id0", "_call")
    calls = asked.select(
        F.col("id0").alias("call_id"),
        F.lit("reply").alias("name"),
        F.to_json(arguments).alias("arguments"),
        F.when(F.col("before").isNotNull(), F.col("_after")).alias("after"),
    )
    # System turns that no user's turn follows.
    followed = users.select(F.col("id0").alias("_asked")).where("_asked IS NOT NULL").distinct()
    told = turns.where("role = 'system'")
    alone = told.join(followed, F.col("id-1") == F.col("_asked"), "left_anti")
    rest = turns.where("role IS NULL OR role NOT IN ('user', 'system')").unionByName(alone)
    answered = F.when(F.col("role") == "assistant", F.col("id1")).otherwise(F.concat(F.col("id0"), F.lit("!")))
    results = rest.select(answered.alias("call_id"), F.col("text").alias("output"), F.lit(False).alias("part"))
    inside = told.join(followed, F.col("id-1") == F.col("_asked"), "left_semi")
    inside = inside.select(F.col("id-1").alias("call_id"), F.col("text").alias("output"), F.lit(True).alias("part"))
    return calls, results.unionByName(inside)


def _before(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, before)`` of distinct turns; a long conversation spans many ranges."""
    ranges = turns.repartitionByRange("conv_id", "turn").withColumn("part", F.spark_partition_id())
    ranges = keep(ranges, "user-turns")
    last = ranges.groupBy("conv_id", "part").agg(F.max("turn").alias("last"))
    earlier = F.lag("last").over(Window.partitionBy("conv_id").orderBy("part"))
    last = last.select("conv_id", "part", earlier.alias("earlier"))
    own = F.lag("turn").over(Window.partitionBy("conv_id", "part").orderBy("turn"))
    joined = ranges.withColumn("own", own).join(last, ["conv_id", "part"])
    return joined.select("conv_id", "turn", F.coalesce("own", "earlier").alias("before"))


def format_calls(calls: DataFrame, results: DataFrame, tools: dict[str, Schema]) -> DataFrame:
    """``(call_id, depth, status, rows, conflict, problems, record)``, a row per call, orphan or conflict.

    A call without an identifier has no depth, and neither has a conflict. Without calls and
    results there are no rows.
    ``record`` is one line of canonical JSON: keys sorted, no white space, null where a value is
    missing. Arguments that are not JSON are kept as they are, as text under ``malformed``.
    """
    linked = keep(link(calls, results), "linked")
    counts = F.col("call_id").isNotNull() & F.col("status").isin("answered", "unanswered")
    ordered = depths(linked.where(counts).select("call_id", "after"))
    ordered = ordered.withColumnRenamed("call_id", "_id")
    rows = left_join(linked.where(counts), ordered, "call_id", "_id").drop("_id")
    rest = linked.where(~counts).withColumn("depth", F.lit(None).cast("long"))
    rows = rows.unionByName(rest)
    conflict, orphan = F.col("status") == "conflict", F.col("status") == "orphan"
    found = F.when(F.col("is_call"), problems(F.col("name"), F.col("arguments"), tools)).otherwise(F.array().cast("array<string>"))
    checked = F.when(orphan, F.array(F.lit("no call"))).when(conflict, F.concat(F.array(F.lit("conflict")), found)).otherwise(found)
    parsed = F.try_parse_json("arguments")
    fields = F.struct(
        "after",
        parsed.alias("arguments"),
        "call_id",
        F.when(parsed.isNull(), F.col("arguments")).alias("malformed"),
        "name",
        "output",
        "status",
    )
    record = F.to_json(fields, {"ignoreNullFields": "false"})
    return rows.select("call_id", "depth", "status", "rows", "conflict", checked.alias("problems"), record.alias("record"))


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    formatted = format_calls(*from_turns(messages), REPLY)
    return formatted.withColumn("problems", F.array_join("problems", "; "))


OP9_SQL = """
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, role, text, conv_id || ':' || turn AS id, conv_id || ':' || (turn - 1) AS id1, conv_id || ':' || (turn + 1) AS next
  FROM conversations
),
users AS (
  SELECT conv_id || ':' || turn AS id, conv_id || ':' || lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS after
  FROM (SELECT DISTINCT conv_id, turn FROM turns WHERE role = 'user')
),
system_rows AS (
  SELECT next AS call_id, text AS output, count(*) AS copies,
    row_number() OVER (PARTITION BY next ORDER BY text NULLS FIRST) AS nr, count(*) OVER (PARTITION BY next) > 1 AS conflict
  FROM turns t WHERE role = 'system' AND EXISTS (SELECT 1 FROM users u WHERE u.id = t.next) GROUP BY next, text
),
raw_calls AS (
  SELECT u.id AS call_id, 'reply' AS name, b.after, u.text,
    '{' || CASE WHEN s.output IS NULL THEN '' ELSE '"system":' || to_json(s.output) || ',' END
    || CASE WHEN u.text IS NULL THEN '' ELSE '"text":' || to_json(u.text) || ',' END || '"turn":' || u.turn || '}' AS arguments
  FROM turns u JOIN users b ON b.id = u.id LEFT JOIN system_rows s ON s.call_id = u.id AND s.nr = 1 WHERE u.role = 'user'
),
call_rows AS (
  SELECT call_id, name, arguments, after, text, count(*) AS copies,
    row_number() OVER (PARTITION BY call_id ORDER BY arguments) AS nr, count(*) OVER (PARTITION BY call_id) > 1 AS conflict
  FROM raw_calls GROUP BY call_id, name, arguments, after, text
),
raw_results AS (
  SELECT CASE WHEN role = 'assistant' THEN id1 ELSE id || '!' END AS call_id, text AS output
  FROM turns t
  WHERE role IS DISTINCT FROM 'user'
    AND NOT (role IS NOT DISTINCT FROM 'system' AND EXISTS (SELECT 1 FROM users u WHERE u.id = t.next))
),
result_rows AS (
  SELECT call_id, output, count(*) AS copies,
    row_number() OVER (PARTITION BY call_id ORDER BY output NULLS FIRST) AS nr, count(*) OVER (PARTITION BY call_id) > 1 AS conflict
  FROM raw_results GROUP BY call_id, output
),
calls AS (SELECT * FROM call_rows WHERE nr = 1),
linked AS (
  SELECT coalesce(c.call_id, r.call_id) AS call_id, c.name, c.arguments, c.after, c.text, r.output, c.call_id IS NOT NULL AS is_call,
    CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
    coalesce(c.copies, 0) + coalesce(r.copies, 0) + coalesce(s.copies, 0) AS rows,
    coalesce(c.conflict, false) OR coalesce(r.conflict, false) OR coalesce(s.conflict, false) AS conflict
  FROM calls c FULL JOIN (SELECT * FROM result_rows WHERE nr = 1) r ON c.call_id = r.call_id
  LEFT JOIN (SELECT * FROM system_rows WHERE nr = 1) s ON s.call_id = c.call_id
  UNION ALL SELECT call_id, name, arguments, after, text, NULL, true, 'conflict', copies, true FROM call_rows WHERE nr > 1
  UNION ALL SELECT call_id, NULL, NULL, NULL, NULL, output, false, 'conflict', copies, true FROM result_rows WHERE nr > 1
  UNION ALL SELECT call_id, NULL, NULL, NULL, NULL, output, false, 'conflict', copies, true FROM system_rows WHERE nr > 1
),
depths(call_id, depth) AS (
  SELECT call_id, 0::BIGINT FROM calls WHERE after IS NULL
  UNION ALL
  SELECT c.call_id, d.depth + 1 FROM calls c JOIN depths d ON c.after = d.call_id
)
SELECT l.call_id, d.depth, l.status, l.rows, l.conflict,
  CASE WHEN l.status = 'orphan' THEN 'no call' WHEN l.status = 'conflict' THEN 'conflict' ELSE '' END
  || CASE WHEN l.is_call AND l.text IS NULL THEN (CASE WHEN l.status = 'conflict' THEN '; ' ELSE '' END) || 'missing text' ELSE '' END AS problems,
  '{"after":' || coalesce(to_json(l.after)::VARCHAR, 'null') || ',"arguments":' || coalesce(l.arguments, 'null')
  || ',"call_id":' || to_json(l.call_id) || ',"malformed":null,"name":' || coalesce(to_json(l.name)::VARCHAR, 'null')
  || ',"output":' || coalesce(to_json(l.output)::VARCHAR, 'null') || ',"status":' || to_json(l.status) || '}' AS record
FROM linked l LEFT JOIN depths d ON d.call_id = l.call_id AND l.status IN ('answered', 'unanswered')
"""
