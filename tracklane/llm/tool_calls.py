"""Chat formatting: tool calls linked to their results, checked and put in order, in DataFrame expressions only.

A message's text is a call message where it is a JSON object with an array `tool_calls` of {id, name, arguments} or
{id, function: {name, arguments}}, and a result where it is an object with a `tool_call_id` (and `content`); any other
text is a plain message. A call message with a content gives a plain message of that content before its calls. An object
that has both gives its calls and its result, whose content is the object's. Calls and
results of a conversation are hash-joined by identifier. Order is topological: messages by turn, a message's calls by
their index, and a result right after its call or at its own turn, whichever is later; `place` numbers a conversation's
rows from 1 in that order (then by JSON text). Conversations are numbered in blocks of BLOCK turns, whose counts are
summed, so one that holds a third of all rows is never one task's; a turn is taken to hold few rows.

Arguments are checked against the tool's schema: every required argument present, each known one of its type, no unknown
one where the schema is closed. A JSON null counts as an absent argument; whole numbers like 1.0 are integers. A tool
without a schema is invalid with reason "unknown tool".

Links: "linked"; "no_result", "orphan_result"; "duplicate" for a call or result whose identifier an earlier one (by
turn, then index; of equals by name and arguments, or by content) of the same conversation bears. Calls, or results,
that are equal in all of these are one that came repeatedly: they keep their rows and get the same link. Null ids link
to nothing. Null conversation, turn, role or text stay null in their own columns and in the JSON; a null turn sorts
first. Malformed JSON is a plain message. Very long texts are like any others. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.llm import common
from tracklane.llm.common import let

#: tool: {argument: (type, required)}; types are string, integer, number, boolean, array and object.
SCHEMAS: dict[str, dict[str, tuple[str, bool]]] = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "calculator": {"expression": ("string", True)},
    "weather": {"city": ("string", True), "unit": ("string", False)},
    "fetch": {"url": ("string", True), "timeout": ("number", False)},
}
_OF_TYPE = {"string": "^STRING$", "integer": "^BIGINT$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT"}
_CALL = "struct<id: string, name: string, arguments: string, function: struct<name: string, arguments: string>>"
_CALLS = f"struct<content: string, tool_calls: array<{_CALL}>>"
#: Turns of a conversation that one task numbers.
BLOCK = 1024


def _quoted(x: Column) -> Column:
    """x as a JSON string, or null."""
    return F.coalesce(F.regexp_extract(F.to_json(F.struct(x.cast("string").alias("x"))), r'(?s)^\{"x":(.*)\}$', 1), F.lit(""))


def _json(**fields: Column) -> Column:
    """A JSON object of ready JSON texts, keys in order; an empty text stands for null."""
    items = [F.concat(F.lit(f'"{k}":'), F.when(F.coalesce(v, F.lit("")) == "", F.lit("null")).otherwise(v)) for k, v in sorted(fields.items())]
    return F.concat(F.lit("{"), F.concat_ws(",", *items), F.lit("}"))


def problems(name: Column, arguments: Column, schemas: Mapping[str, Mapping[str, tuple[str, bool]]], closed: bool = True) -> Column:
    """What is wrong with a call's arguments, joined by "; ", or an empty text."""

    def of(v: Column) -> Column:
        kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
        is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
        out = F.lit("unknown tool")
        for tool, schema in sorted(schemas.items()):
            wrong = []
            for arg, (kind_name, required) in sorted(schema.items()):
                got = F.coalesce(kind(f"$.{arg}"), F.lit("VOID"))
                fits = got.rlike(_OF_TYPE[kind_name])
                if kind_name == "integer":
                    fits |= got.rlike(_OF_TYPE["number"]) & (F.try_variant_get(v, f"$.{arg}", "double") % 1 == 0)
                wrong.append(F.when(got == "VOID", f"missing {arg}" if required else None).when(~fits, f"{arg} is not {kind_name}"))
            if closed:
                keys = F.json_object_keys(F.to_json(v))
                extra = F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*map(F.lit, sorted(schema))))
                wrong.append(F.when(F.size(extra) > 0, F.concat(F.lit("unknown "), F.array_join(F.array_sort(extra), ", "))))
            out = F.when(name == tool, F.when(is_object, F.concat_ws("; ", *wrong)).otherwise("arguments are no object")).otherwise(out)
        return out

    return let(F.try_parse_json(arguments), of)


def placed(rows: DataFrame) -> DataFrame:
    """`rows` with their place in their conversation."""
    block = F.floor(F.col("order_turn") / BLOCK)
    rows = rows.withColumn("block", block)
    own = W.partitionBy("conv", "block").orderBy("order_turn", "order_rank", "order_index", "kind", "json")
    sizes = rows.groupBy("conv", "block").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")).filter("before > 0")
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    return rows.withColumn("inside", F.row_number().over(own)).join(before, same, "left").withColumn("place", F.col("inside") + F.coalesce("before", F.lit(0))).drop("c", "b", "block", "inside", "before")


def link(
    messages: DataFrame, schemas: Mapping[str, Mapping[str, tuple[str, bool]]] = SCHEMAS, closed: bool = True,
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row for each plain message, call and result.

    (conv, place, turn, order_turn, order_rank, order_index, kind, role, call_id, name, link, valid, problems, json)
    """
    rows = messages.select(
        messages[conv_col].alias("conv"), messages[turn_col].cast("bigint").alias("turn"), messages[role_col].cast("string").alias("role"), messages[text_col].alias("text")
    )
    text, looks = F.col("text"), F.col("text").rlike(r"^\s*\{")
    # Strings in `arguments` arrive as raw JSON text of the object, or as the text of a JSON string.
    rows = rows.withColumn("call", F.when(looks, F.from_json(text, _CALLS))).withColumn("rid", F.when(looks, F.get_json_object(text, "$.tool_call_id")))
    n_calls = F.size(F.coalesce(F.col("call.tool_calls"), F.array().cast(f"array<{_CALL}>")))
    rows = rows.withColumns({"is_call": n_calls > 0, "is_result": F.col("rid").isNotNull()})
    string, boolean = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    canonical = lambda raw: F.coalesce(F.to_json(F.try_parse_json(raw)), _quoted(raw))
    role = _quoted(F.col("role"))

    said = F.when(F.col("is_call"), F.nullif(F.col("call.content"), F.lit(""))).otherwise(text)
    plain = rows.filter("NOT is_result").filter(~F.col("is_call") | (F.col("call.content") != "")).select(
        "conv", "turn", F.col("turn").alias("order_turn"), F.lit(0).alias("order_rank"), F.lit(0).alias("order_index"),
        F.lit("message").alias("kind"), "role", string.alias("call_id"), string.alias("name"), F.lit("none").alias("link"), boolean.alias("valid"), string.alias("problems"),
        _json(role=role, content=_quoted(said), type=F.lit('"message"')).alias("json"),
    )

    calls = rows.filter("is_call").select("conv", "turn", "role", F.posexplode("call.tool_calls").alias("index", "c"))
    calls = calls.select(
        "conv", "turn", "role", "index", F.col("c.id").alias("call_id"), F.coalesce("c.name", "c.function.name").alias("name"), F.coalesce("c.arguments", "c.function.arguments").alias("arguments")
    )
    results = rows.filter("is_result").select("conv", "turn", "role", F.col("rid").alias("call_id"), F.get_json_object("text", "$.content").alias("content"))
    keys = ["conv", "call_id"]
    # The earliest call and result of each identifier; partial minimums before the shuffle.
    in_turn, came = F.struct("turn", "index", "name", "arguments"), F.struct("turn", "content")
    first_call = calls.filter("call_id IS NOT NULL").groupBy(*keys).agg(F.min(in_turn).alias("first_call"))
    first_result = results.groupBy(*keys).agg(F.min(came).alias("first_result"))
    linked = calls.join(first_call, keys, "left").join(first_result, keys, "left")
    linked = linked.withColumn("problems", problems(F.col("name"), F.col("arguments"), schemas, closed))
    later = F.col("first_call").isNotNull() & ~in_turn.eqNullSafe(F.col("first_call"))
    call_rows = linked.select(
        "conv", "turn", F.col("turn").alias("order_turn"), F.lit(1).alias("order_rank"), F.col("index").alias("order_index"), F.lit("call").alias("kind"), "role", "call_id", "name",
        F.when(later, "duplicate").when(F.col("first_result").isNotNull(), "linked").otherwise("no_result").alias("link"),
        (F.col("problems") == "").alias("valid"), "problems",
        _json(role=role, type=F.lit('"tool_call"'), id=_quoted(F.col("call_id")), name=_quoted(F.col("name")), arguments=canonical(F.col("arguments"))).alias("json"),
    )
    answers = results.join(first_call, keys, "left").join(first_result, keys, "left")
    result_rows = answers.select(
        "conv", "turn", F.greatest("turn", "first_call.turn").alias("order_turn"), F.lit(2).alias("order_rank"), F.coalesce("first_call.index", F.lit(0)).alias("order_index"),
        F.lit("result").alias("kind"), "role", "call_id", string.alias("name"),
        F.when(~came.eqNullSafe(F.col("first_result")), "duplicate").when(F.col("first_call").isNotNull(), "linked").otherwise("orphan_result").alias("link"),
        boolean.alias("valid"), string.alias("problems"),
        _json(role=role, type=F.lit('"tool_result"'), id=_quoted(F.col("call_id")), content=canonical(F.col("content"))).alias("json"),
    )
    out = placed(plain.union(call_rows).union(result_rows)).withColumnsRenamed({"conv": conv_col, "turn": turn_col, "role": role_col})
    return out.select(conv_col, "place", turn_col, "order_turn", "order_rank", "order_index", "kind", role_col, "call_id", "name", "link", "valid", "problems", "json")


def with_calls(conversations: DataFrame) -> DataFrame:
    """`conversations` with calls and results made of its rows, since the table holds plain text only.

    An assistant's turn becomes a call message with its text as content, and of every third one also a second call; the
    arguments hold the text, and some are wrong, of an unknown tool, or under an identifier that was used. A user's turn
    becomes the result of the turn before, of the turn after (so it comes too early), of a call that has its result, or
    of a second call that may not be there, or stays as it is. Every seventh text is broken JSON.
    """
    c, t, text = F.col("conv_id"), F.col("turn"), F.col("text")
    n = c + t
    name = F.element_at(F.array(*map(F.lit, ("search", "calculator", "weather", "fetch", "translate"))), (n % 5 + 1).cast("int"))
    obj = lambda **x: F.to_json(F.struct(*[v.alias(k) for k, v in x.items()]))
    arguments = (
        F.when(n % 5 == 0, F.when(c % 2 == 0, obj(query=text, limit=t)).otherwise(obj(limit=F.lit("many"), query=text)))
        .when(n % 5 == 1, obj(expression=F.concat_ws("+", t.cast("string"), c.cast("string")))).when(n % 5 == 2, obj(unit=F.lit("C")))
        .when(n % 5 == 3, obj(url=F.substring(text, 1, 20), timeout=F.lit(1.5), more=t)).otherwise(obj(text=text))
    )
    one = lambda id_, name_, raw: F.concat(F.lit('{"id":"'), id_, F.lit('","name":"'), name_, F.lit('","arguments":'), raw, F.lit("}"))
    number = lambda x: x.cast("string")
    first = one(F.concat(F.lit("c"), number(F.when(t % 4 == 3, t - 2).otherwise(t))), name, arguments)
    second = one(F.concat(F.lit("d"), number(t)), F.lit("calculator"), F.lit('"{\\"expression\\": \\"1\\"}"'))
    calls = F.concat(F.lit('{"content":'), _quoted(text), F.lit(',"tool_calls":['), first, F.when(n % 3 == 0, F.concat(F.lit(","), second)).otherwise(""), F.lit("]}"))
    of = F.when(n % 4 == 1, F.concat(F.lit("c"), number(t - 1))).when(n % 4 == 2, F.concat(F.lit("c"), number(t + 1)))
    of = of.otherwise(F.when(c % 2 == 1, F.concat(F.lit("c"), number(t - 3))).otherwise(F.concat(F.lit("d"), number(t - 1))))
    made = (
        F.when(n % 7 == 0, F.concat(F.lit('{"tool_calls": ['), text)).when(F.col("role") == "assistant", calls)
        .when((F.col("role") == "user") & (n % 4 != 0), obj(tool_call_id=of, content=text)).otherwise(text)
    )
    return conversations.select("conv_id", "turn", "role", made.alias("text"))


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(with_calls(common.table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


ORACLE_SQL = """
WITH t AS (SELECT conv_id, turn, role, text, conv_id + turn AS n, CAST(to_json(text) AS VARCHAR) AS q, '"' || role || '"' AS r FROM conversations),
calls AS (
  SELECT conv_id, turn, role, r, 0 AS idx, 'c' || CASE WHEN turn % 4 = 3 THEN turn - 2 ELSE turn END AS call_id,
    ['search', 'calculator', 'weather', 'fetch', 'translate'][n % 5 + 1] AS name,
    CASE n % 5 WHEN 0 THEN '{"limit":' || CASE WHEN conv_id % 2 = 0 THEN CAST(turn AS VARCHAR) ELSE '"many"' END || ',"query":' || q || '}'
      WHEN 1 THEN '{"expression":"' || turn || '+' || conv_id || '"}' WHEN 2 THEN '{"unit":"C"}'
      WHEN 3 THEN '{"more":' || turn || ',"timeout":1.5,"url":' || CAST(to_json(text[:20]) AS VARCHAR) || '}' ELSE '{"text":' || q || '}' END AS args,
    CASE n % 5 WHEN 0 THEN CASE WHEN conv_id % 2 = 0 THEN '' ELSE 'limit is not integer' END WHEN 1 THEN '' WHEN 2 THEN 'missing city' WHEN 3 THEN 'unknown more' ELSE 'unknown tool' END AS problems
  FROM t WHERE role = 'assistant' AND n % 7 <> 0
  UNION ALL SELECT conv_id, turn, role, r, 1, 'd' || turn, 'calculator', '{"expression":"1"}', '' FROM t WHERE role = 'assistant' AND n % 7 <> 0 AND n % 3 = 0),
results AS (SELECT conv_id, turn, role, r, q, CASE n % 4 WHEN 1 THEN 'c' || (turn - 1) WHEN 2 THEN 'c' || (turn + 1) ELSE CASE WHEN conv_id % 2 = 1 THEN 'c' || (turn - 3) ELSE 'd' || (turn - 1) END END AS call_id
  FROM t WHERE role = 'user' AND n % 4 <> 0 AND n % 7 <> 0),
c1 AS (SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn, idx) AS k FROM calls),
r1 AS (SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn) AS k FROM results),
rows AS (
  SELECT conv_id, turn, turn AS order_turn, 0 AS order_rank, 0 AS order_index, 'message' AS kind, role, CAST(NULL AS VARCHAR) AS call_id, CAST(NULL AS VARCHAR) AS name, 'none' AS link,
    CAST(NULL AS BOOLEAN) AS valid, CAST(NULL AS VARCHAR) AS problems,
    '{"content":' || CASE WHEN n % 7 = 0 THEN CAST(to_json('{"tool_calls": [' || text) AS VARCHAR) ELSE q END || ',"role":' || r || ',"type":"message"}' AS json
  FROM t WHERE n % 7 = 0 OR role = 'assistant' OR role = 'system' OR n % 4 = 0
  UNION ALL SELECT c.conv_id, c.turn, c.turn, 1, c.idx, 'call', c.role, c.call_id, c.name, CASE WHEN c.k > 1 THEN 'duplicate' WHEN r.turn IS NOT NULL THEN 'linked' ELSE 'no_result' END,
    c.problems = '', c.problems, '{"arguments":' || args || ',"id":"' || c.call_id || '","name":"' || c.name || '","role":' || c.r || ',"type":"tool_call"}'
  FROM c1 c LEFT JOIN r1 r ON r.conv_id = c.conv_id AND r.call_id = c.call_id AND r.k = 1
  UNION ALL SELECT r.conv_id, r.turn, greatest(r.turn, coalesce(c.turn, r.turn)), 2, coalesce(c.idx, 0), 'result', r.role, r.call_id, NULL,
    CASE WHEN r.k > 1 THEN 'duplicate' WHEN c.turn IS NOT NULL THEN 'linked' ELSE 'orphan_result' END, NULL, NULL,
    '{"content":' || r.q || ',"id":"' || r.call_id || '","role":' || r.r || ',"type":"tool_result"}'
  FROM r1 r LEFT JOIN c1 c ON r.conv_id = c.conv_id AND r.call_id = c.call_id AND c.k = 1)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY order_turn, order_rank, order_index, kind, json) AS BIGINT) AS place, turn, order_turn,
  CAST(order_rank AS INT) AS order_rank, CAST(order_index AS INT) AS order_index, kind, role, call_id, name, link, valid, problems, json FROM rows"""
