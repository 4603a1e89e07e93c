"""Tool calls of conversations linked to their results, ordered, validated and written as canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townads.llm.frames import stored, table

_TYPES = {
    "object": dict,
    "array": list,
    "string": str,
    "boolean": bool,
    "integer": int,
    "number": (int, float),
    "null": type(None),
}


def _of_type(value: object, kind: str) -> bool:
    """A boolean is no number; a number without a fraction is an integer, however it is written."""
    if isinstance(value, bool):
        return kind == "boolean"
    return isinstance(value, _TYPES[kind]) or kind == "integer" and isinstance(value, float) and value.is_integer()


def _same(a: object, b: object) -> bool:
    """Equal as JSON: 1 and 1.0 are, 1 and true are not."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_same(a[name], b[name]) for name in a)
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_same, a, b))
    return a == b


def errors(value: object, schema: dict, at: str = "$") -> list[str]:
    """Where a JSON value departs from a schema of type, enum, required, properties, additionalProperties,
    items, minimum, maximum, minLength and maxLength."""
    found = []
    kind = schema.get("type")
    if kind and not _of_type(value, kind):
        return [f"{at}: not of type {kind}"]
    if "enum" in schema and not any(_same(value, x) for x in schema["enum"]):
        found.append(f"{at}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            found.append(f"{at}: below minimum")
        if value > schema.get("maximum", value):
            found.append(f"{at}: above maximum")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        found.append(f"{at}: length out of range")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{name}: missing" for name in sorted(schema.get("required", [])) if name not in value]
        for name in sorted(value):
            if name in known:
                found += errors(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{name}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += errors(item, schema["items"], f"{at}[{i}]")
    return found


def _unique(pairs: list[tuple[str, object]]) -> dict:
    if len({name for name, _ in pairs}) < len(pairs):
        raise ValueError("a name occurs twice")
    return dict(pairs)


def canonical(value: object) -> str:
    """JSON with sorted names, without spaces, non-ASCII characters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _records(schemas: dict[str, dict]):
    names = ["conversation", "call_id", "level", "status", "valid", "errors", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                found, arguments = [], None
                if row["status"] != "orphan result":
                    try:
                        arguments = json.loads(row["arguments"] or "", object_pairs_hook=_unique)
                        schema = schemas.get(row["name"])
                        found = ["unknown tool"] if schema is None else errors(arguments, schema)
                        canonical(arguments).encode()  # half a surrogate pair cannot be written
                    except (ValueError, RecursionError):
                        found, arguments = ["arguments are no JSON"], None
                record = {"arguments": arguments, "call_id": row["call_id"], "name": row["name"], "result": row["content"]}
                out.append(
                    (row["conversation"], row["call_id"], row["level"], row["status"],
                     not found and row["status"] != "orphan result", found, canonical(record))
                )
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.string()]
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Topological levels: rows (node, level) with 1 for nodes that wait for none and, for others, one more
    than the largest level that they wait for; nodes on or behind a cycle have none.

    ``edges`` (node, after) among the nodes, without repetitions. Nodes that wait for one other only are
    first led back to the nearest node that does not, by doubling steps, so a conversation of any length
    takes a logarithm of rounds. What is left, nodes that wait for several, is settled level by level.
    Every round is a stored table, so plans stay small.
    """
    waiting = stored(edges.groupBy("node").agg(F.count("*").alias("waits"), F.min("after").alias("to")), "waits")
    single = waiting.where("waits = 1").select("node", "to", F.lit(1).cast("long").alias("steps"))
    goes_on = single.select(F.col("node").alias("to"), F.lit(True).alias("open"))
    back = stored(
        single.join(goes_on, "to", "left").select("node", "to", "steps", F.coalesce("open", F.lit(False)).alias("open")),
        "back",
    )
    left, before = back.where("open").count(), None
    while left and left != before:  # no fewer than before: only cycles and what waits for them
        on = back.select(*(F.col(c).alias(f"next_{c}") for c in back.columns)).withColumnRenamed("next_node", "to")
        taken = F.col("open") & F.col("next_to").isNotNull()
        back = stored(
            back.join(on, "to", "left").select(
                "node",
                F.when(taken, F.col("next_to")).otherwise(F.col("to")).alias("to"),
                (F.col("steps") + F.when(taken, F.col("next_steps")).otherwise(0)).alias("steps"),
                F.when(taken, F.col("next_open")).otherwise(F.col("open")).alias("open"),
            ),
            "back",
        )
        left, before = back.where("open").count(), left
    led = back.where("NOT open").select("node", "to", "steps")
    known = stored(
        nodes.join(waiting, "node", "left_anti").select("node", F.lit(1).cast("long").alias("level")), "levels"
    )
    several = waiting.where("waits > 1").select("node", "waits")
    through = led.select(F.col("node").alias("after"), "to", "steps")
    needs = stored(
        edges.join(several, "node")
        .join(through, "after", "left")
        .select(
            "node", "waits", F.coalesce("to", "after").alias("to"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps")
        ),
        "needs",
    )
    while needs.limit(1).count():
        at = known.select(F.col("node").alias("to"), "level")
        ready = stored(
            needs.join(at, "to")
            .groupBy("node", "waits")
            .agg(F.count("*").alias("met"), F.max(F.col("level") + F.col("steps")).alias("level"))
            .where("met = waits")
            .select("node", "level"),
            "ready",
        )
        if not ready.limit(1).count():
            break
        known = stored(known.union(ready), "levels")
        needs = stored(needs.join(ready, "node", "left_anti"), "needs")
    at = known.select(F.col("node").alias("to"), "level")
    return known.union(led.join(at, "to").select("node", (F.col("level") + F.col("steps")).alias("level")))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Links calls and results by identifier.

    ``calls``: conversation (long), call_id, after (array of call ids to come first), name, arguments
    (JSON text). ``results``: conversation, call_id, content. Identifiers hold within a conversation.

    One row per call, and per result without a call: ``conversation``, ``call_id``, ``level`` (the order
    in which calls can run: by level, then call_id; null on or behind a cycle and for orphans),
    ``status`` (answered, unanswered or orphan result), ``valid``, ``errors`` and ``record``, the
    canonical JSON of arguments, call_id, name and result.

    Nulls and edges: rows with a null conversation or call_id are left out, as nothing can name them; of
    several calls or results with one identifier the least (by all fields) counts; a dependency on itself
    is a cycle, on an unknown call it is ignored; null, empty or broken arguments, arguments with half a surrogate
    pair and arguments that name a field twice are invalid; a null result makes ``"result":null`` of status answered.
    """
    called = (
        calls.select("conversation", "call_id", F.struct("name", "arguments", "after").alias("call"))
        .dropna(subset=["conversation", "call_id"])
        .groupBy("conversation", "call_id")
        .agg(F.min("call").alias("call"))
        .select("conversation", "call_id", "call.*")
    )
    called = stored(called.withColumn("node", F.to_json(F.struct("conversation", "call_id"))), "calls")
    answers = (
        results.select("conversation", "call_id", F.struct("content").alias("result"))
        .dropna(subset=["conversation", "call_id"])
        .groupBy("conversation", "call_id")
        .agg(F.min("result").alias("result"))
    )
    named = F.struct("conversation", F.col("before").alias("call_id"))
    edges = (
        called.select("node", "conversation", F.explode("after").alias("before"))
        .select("node", F.to_json(named).alias("after"))
        .distinct()
    )
    edges = stored(edges.join(called.select(F.col("node").alias("after")), "after", "left_semi"), "edges")
    ordered = levels(called.select("node"), edges)
    status = (
        F.when(F.col("called").isNull(), "orphan result").when(F.col("result").isNull(), "unanswered").otherwise("answered")
    )
    both = (
        called.join(ordered, "node", "left")
        .withColumn("called", F.lit(True))
        .join(answers, ["conversation", "call_id"], "full")
        .select("conversation", "call_id", "level", "name", "arguments", status.alias("status"), "result.content")
    )
    return both.mapInArrow(
        _records(schemas),
        "conversation long, call_id string, level long, status string, valid boolean, errors array<string>, record string",
    )


# The tool that conversations are read as calling: every assistant turn asks it about its own text.
MAX_WORDS = 40
SCHEMAS = {
    "measure": {
        "type": "object",
        "required": ["text", "n_words"],
        "properties": {
            "text": {"type": "string", "minLength": 1},
            "n_words": {"type": "integer", "minimum": 1, "maximum": MAX_WORDS},
        },
        "additionalProperties": False,
    }
}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that conversations stand for: an assistant turn is a call that comes after the
    assistant turn before it, two turns earlier; the user turn that follows is its result."""
    name = F.concat_ws("-", F.lit("call"), F.col("turn").cast("string"))
    before = F.concat_ws("-", F.lit("call"), (F.col("turn") - 2).cast("string"))
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda w: w != ""))
    calls = turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("conversation"),
        name.alias("call_id"),
        F.when(F.col("turn").isNotNull(), F.array(before)).alias("after"),
        F.lit("measure").alias("name"),
        F.to_json(F.struct("text", words.alias("n_words"))).alias("arguments"),
    )
    answered = F.concat_ws("-", F.lit("call"), (F.col("turn") - 1).cast("string"))
    results = turns.where("role = 'user' AND turn > 0").select(
        F.col("conv_id").alias("conversation"), answered.alias("call_id"), F.col("text").alias("content")
    )
    return calls, results


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls that all conversations stand for, linked to their results."""
    linked = link(*conversation_calls(table(spark, sf_dir, "conversations")), SCHEMAS)
    return linked.select(
        F.col("conversation").alias("conv_id"),
        "call_id",
        "level",
        "status",
        "valid",
        F.array_join("errors", "; ").alias("errors"),
        "record",
    )


QUERIES = {"op2_tool_calls": op2_tool_calls}
ORACLE = {
    "op2_tool_calls": rf"""
WITH RECURSIVE call AS (
  SELECT conv_id, turn, min(text) AS text FROM conversations
  WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn
), result AS (
  SELECT conv_id, turn - 1 AS turn, min(text) AS text FROM conversations
  WHERE role = 'user' AND turn > 0 AND conv_id IS NOT NULL GROUP BY conv_id, turn
), ordered AS (
  SELECT conv_id, turn, 1::BIGINT AS level FROM call c
  WHERE NOT EXISTS (SELECT 1 FROM call b WHERE b.conv_id = c.conv_id AND b.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, o.level + 1 FROM ordered o JOIN call c ON c.conv_id = o.conv_id AND c.turn = o.turn + 2
), both_sides AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS turn, o.level AS level,
    c.conv_id IS NOT NULL AS called, r.conv_id IS NOT NULL AS answered, c.text AS asked, r.text AS content,
    len(list_filter(string_split(c.text, ' '), lambda w: w <> '')) AS n
  FROM call c FULL JOIN result r ON c.conv_id = r.conv_id AND c.turn = r.turn
  LEFT JOIN ordered o ON o.conv_id = c.conv_id AND o.turn = c.turn
), judged AS (
  SELECT *, CASE WHEN NOT called THEN '' ELSE array_to_string(list_filter([
    CASE WHEN n < 1 THEN '$.n_words: below minimum' WHEN n > {MAX_WORDS} THEN '$.n_words: above maximum' END,
    CASE WHEN asked IS NULL THEN '$.text: missing' WHEN asked = '' THEN '$.text: length out of range' END
  ], lambda e: e IS NOT NULL), '; ') END AS errors FROM both_sides
)
SELECT conv_id, 'call-' || turn AS call_id, level,
  CASE WHEN NOT called THEN 'orphan result' WHEN NOT answered THEN 'unanswered' ELSE 'answered' END AS status,
  called AND errors = '' AS valid, errors,
  '{{"arguments":' || CASE WHEN called THEN '{{"n_words":' || n || ',"text":' || to_json(asked)::VARCHAR || '}}' ELSE 'null' END
    || ',"call_id":"call-' || turn || '","name":' || CASE WHEN called THEN '"measure"' ELSE 'null' END
    || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}}' AS record
FROM judged
"""
}
