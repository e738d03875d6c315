"""Chat formatting: tool calls linked with their results, ordered, validated, as canonical JSON.

Calls stand in messages as ``<tool_call>{...}</tool_call>`` or as a JSON object with ``tool_calls``; a call has ``id``,
``name`` and ``arguments`` (an object, or JSON text of one). Results stand in messages of role ``tool`` as JSON objects
with ``tool_call_id`` and ``content``. Calls and results are joined by conversation and identifier. A call whose arguments
name another call's id under ``$result`` comes after it, a result right after its call. Every message is one row with
its place, so a conversation of any length is never gathered.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrade.session import write_stage

OPEN, CLOSE = "<tool_call>", "</tool_call>"
TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}

#: Schemas of known tools: JSON schema of the arguments. Calls of other tools are kept and marked as unknown.
SCHEMAS: dict[str, dict] = {
    "search": {"type": "object", "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1}}, "required": ["query"], "additionalProperties": False},
    "calculator": {"type": "object", "properties": {"expression": {"type": "string"}}, "required": ["expression"], "additionalProperties": False},
}


def canonical(value: Any) -> str:
    """JSON with sorted keys, no white space and no escapes but the needed ones."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def loads(text: str) -> Any:
    """Value of a JSON text, None for any other text; repeated keys, NaN and numbers beyond the doubles are no JSON here."""

    def pairs(items: list[tuple[str, Any]]) -> dict:
        if len({k for k, _ in items}) < len(items):
            raise ValueError("repeated key")
        return dict(items)

    def constant(name: str) -> Any:
        raise ValueError(name)

    def number(digits: str) -> float:
        value = float(digits)
        if math.isinf(value):
            raise ValueError(digits)  # JSON has no word for it
        return value

    try:
        value = json.loads(text, object_pairs_hook=pairs, parse_constant=constant, parse_float=number)
        if "\\ud" in text.lower():
            canonical(value).encode()  # half of a surrogate pair is no text
        return value
    except (ValueError, RecursionError):
        return None


def references(value: Any) -> list[str]:
    """Ids of the calls whose results the arguments use."""
    found, rest = [], [value]
    while rest:
        one = rest.pop()
        if isinstance(one, dict):
            if isinstance(one.get("$result"), str):
                found.append(one["$result"])
            rest += one.values()
        elif isinstance(one, list):
            rest += one
    return sorted(set(found))


def invalid(value: Any, schema: Mapping, path: str = "$") -> list[str]:
    """What breaks the schema: type, enum, required, properties, additionalProperties, items, minimum, maximum, pattern."""
    if isinstance(value, dict) and set(value) == {"$result"}:
        return []
    out = []
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds or []
    fits = [isinstance(value, TYPES[k]) and (k == "boolean" or not isinstance(value, bool) or k not in ("integer", "number")) for k in kinds if k in TYPES]
    if fits and not any(fits):
        return [f"{path}: type"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: enum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: required" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += invalid(value[k], known[k], f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{path}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += invalid(x, schema["items"], f"{path}[{i}]")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        out += [f"{path}: {k}" for k, bad in (("minimum", lambda b: value < b), ("maximum", lambda b: value > b)) if k in schema and bad(schema[k])]
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        out.append(f"{path}: pattern")
    return out


def read_call(value: Any, schemas: Mapping[str, Mapping]) -> dict | None:
    if not isinstance(value, dict) or not isinstance(value.get("id"), str) or not isinstance(value.get("name"), str):
        return None
    arguments = value.get("arguments", {})
    if isinstance(arguments, str):
        arguments = loads(arguments)
    errors = ["$: no object"] if not isinstance(arguments, dict) else invalid(arguments, schemas[value["name"]]) if value["name"] in schemas else ["$: unknown tool"]
    return {"id": value["id"], "name": value["name"], "arguments": canonical(arguments), "uses": references(arguments), "errors": errors}


def unreadable(calls: list[dict | None]) -> list[str]:
    return [f"call {i}: unreadable" for i, c in enumerate(calls, 1) if c is None]


def read_tags(text: str, schemas: Mapping[str, Mapping]) -> tuple[str, list[dict | None]]:
    """Text without the tagged calls that can be read, and all calls. One that can't be read ends where the next begins."""
    rest, calls, at = [], [], 0
    while (start := text.find(OPEN, at)) >= 0:
        rest.append(text[at:start])
        begin = start + len(OPEN)
        close = text.find(CLOSE, begin)
        call = read_call(loads(text[begin:close]), schemas) if close >= 0 else None
        at = close + len(CLOSE) if close >= 0 else len(text)
        if call is None:
            inner = text.find(OPEN, begin, at)
            at = inner if inner >= 0 else at
            rest.append(text[start:at])
        calls.append(call)
    return "".join([*rest, text[at:]]).strip(), calls


def read_message(role: str | None, text: str | None, schemas: Mapping[str, Mapping]) -> tuple[str, list[dict], str | None, list[str]]:
    """Content without the calls that can be read, these calls, the id that a result answers, and an error per other call."""
    text = text or ""
    if role == "tool":
        value = loads(text)
        if isinstance(value, dict) and isinstance(value.get("tool_call_id"), str):
            content = value.get("content")
            return (content if isinstance(content, str) else canonical(content)), [], value["tool_call_id"], []
        return text, [], None, []
    if role != "assistant":
        return text, [], None, []
    value = loads(text) if text[:1] == "{" else None
    if isinstance(value, dict) and isinstance(value.get("tool_calls"), list):
        calls = [read_call(x, schemas) for x in value["tool_calls"]]
        if all(calls):
            return value.get("content") if isinstance(value.get("content"), str) else "", calls, None, []
        # The object stays, with the calls that can't be read.
        rest = canonical(value | {"tool_calls": [x for x, c in zip(value["tool_calls"], calls) if not c]}) if any(calls) else text
        return rest, [c for c in calls if c], None, unreadable(calls)
    rest, calls = read_tags(text, schemas)
    errors = unreadable(calls)
    if value is None and text[:1] == "{" and '"tool_calls"' in text or isinstance(value, dict) and value.get("tool_calls") is not None:
        errors.append("tool_calls: unreadable")
    return rest if any(calls) else text, [c for c in calls if c], None, errors


CALL = "struct<id:string,name:string,arguments:string,uses:array<string>,errors:array<string>>"


def read_messages(chats: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """Adds ``content``, ``calls``, ``answers`` (the id that a result names) and ``unreadable`` (errors of other calls)."""

    kind = pa.struct([
        ("content", pa.string()),
        ("calls", pa.list_(pa.struct([("id", pa.string()), ("name", pa.string()), ("arguments", pa.string()), ("uses", pa.list_(pa.string())), ("errors", pa.list_(pa.string()))]))),
        ("answers", pa.string()),
        ("unreadable", pa.list_(pa.string())),
    ])

    @F.arrow_udf(f"struct<content:string,calls:array<{CALL}>,answers:string,unreadable:array<string>>")
    def read(roles: pa.Array, texts: pa.Array) -> pa.Array:
        out = [read_message(r, t, schemas) for r, t in zip(roles.to_pylist(), texts.to_pylist())]
        return pa.array([dict(zip(("content", "calls", "answers", "unreadable"), x)) for x in out], kind)

    found = chats.select("conv_id", "turn", "role", read("role", "text").alias("m"))
    return found.select("conv_id", "turn", "role", "m.content", "m.calls", "m.answers", "m.unreadable")


def levels(calls: DataFrame) -> DataFrame:
    """Place of every call: (conv_id, id, turn, level). A call stands at the latest turn of itself and the calls it uses,
    one level below those of that turn; calls in a cycle, or that use one, are marked with a null level."""
    uses = write_stage(calls.select("conv_id", "id", F.explode("uses").alias("needs")).distinct(), "chat-uses")
    first = calls.groupBy("conv_id", "id").agg(F.min("turn").alias("turn")).select("conv_id", "id", "turn")
    own = write_stage(first, "chat-calls")
    needs = write_stage(uses.join(own.select("conv_id", F.col("id").alias("needs")), ["conv_id", "needs"]), "chat-needs")
    waiting = needs.select("conv_id", "id").distinct()
    done = write_stage(own.join(waiting, ["conv_id", "id"], "left_anti").select("conv_id", "id", "turn", F.lit(0).alias("level")), "chat-level")
    left = needs.count()
    while left:
        # Kahn's rounds: calls of which all needs are placed.
        placed = needs.join(done.select("conv_id", F.col("id").alias("needs"), F.struct("turn", "level").alias("at")), ["conv_id", "needs"], "left")
        ready = placed.groupBy("conv_id", "id").agg(F.max("at").alias("at"), F.count_if(F.col("at").isNull()).alias("open")).filter("open = 0")
        late = ready.join(own, ["conv_id", "id"]).join(done, ["conv_id", "id"], "left_anti")
        after = F.when(F.col("turn") > F.col("at.turn"), 0).otherwise(F.col("at.level") + 1)
        more = write_stage(late.select("conv_id", "id", F.greatest("turn", "at.turn").alias("turn"), after.alias("level")), "chat-level")
        if more.isEmpty():
            break
        done = done.unionByName(more)
    rest = own.join(done, ["conv_id", "id"], "left_anti").select("conv_id", "id", "turn", F.lit(None).cast("int").alias("level"))
    return done.unionByName(rest)


def format_chats(chats: DataFrame, schemas: Mapping[str, Mapping] = SCHEMAS) -> DataFrame:
    """One row per message: conv_id, turn, role, at_turn, at_level, n_calls, n_answered, linked, errors, message.

    Messages of a conversation ordered by (at_turn, at_level, turn, message) are in topological order. ``message`` is
    canonical JSON with role, content, and tool_calls or tool_call_id. ``linked`` tells for a result whether its call is
    there. ``errors`` lists calls that can't be read (they stay in the content, the others of the message are read),
    schema errors, calls without a result, repeated ids (the call of least turn is linked) and cycles. Null texts are empty
    messages, null roles stay null; rows without conv_id or turn are kept and never linked; repeated rows are kept; other
    columns are ignored; an empty table gives no rows.
    """
    rows = write_stage(read_messages(chats, schemas), "chat-messages")
    calls = rows.filter(F.size("calls") > 0).select("conv_id", "turn", F.explode("calls").alias("c")).select("conv_id", "turn", "c.id", "c.uses")
    answers = rows.filter("answers is not null").groupBy("conv_id", F.col("answers").alias("id")).agg(F.count("*").alias("n_results"))
    counted = calls.groupBy("conv_id", "id").agg(F.count("*").alias("n_same"))
    known = levels(calls).join(counted, ["conv_id", "id"]).join(answers, ["conv_id", "id"], "left")
    known = write_stage(known.select("conv_id", "id", F.col("turn").alias("to_turn"), "level", "n_same", F.coalesce("n_results", F.lit(0)).alias("n_results")), "chat-known")
    # Only messages with calls are regrouped, by their own turn.
    called = rows.filter(F.size("calls") > 0).select("conv_id", "turn", F.explode("calls").alias("c")).distinct()
    of_calls = called.join(known, (called["conv_id"] == known["conv_id"]) & (called["c.id"] == known["id"])).select(
        called["conv_id"], "turn", "to_turn", "level", "n_results", F.col("c.id").alias("id"), "n_same", F.col("c.errors").alias("errors")
    )
    notes = F.concat(
        F.transform("errors", lambda e: F.concat("id", F.lit(" "), e)),
        F.when(F.col("n_results") == 0, F.array(F.concat("id", F.lit(": no result")))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("n_same") > 1, F.array(F.concat("id", F.lit(": repeated id")))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("level").isNull(), F.array(F.concat("id", F.lit(": cycle")))).otherwise(F.array().cast("array<string>")),
    )
    by_message = of_calls.groupBy("conv_id", "turn").agg(
        F.max(F.struct("to_turn", F.coalesce("level", F.lit(0)).alias("level"))).alias("at"), F.count_if(F.col("n_results") > 0).alias("n_answered"),
        F.array_sort(F.flatten(F.collect_set(notes))).alias("notes"),
    )
    plain = rows.filter("size(calls) = 0 and answers is null").select("*", F.lit(None).cast("struct<to_turn:bigint,level:int>").alias("at"), F.lit(0).cast("long").alias("n_answered"), F.lit(None).cast("boolean").alias("linked"), F.col("unreadable").alias("notes"))
    with_calls = rows.filter(F.size("calls") > 0).join(by_message, ["conv_id", "turn"], "left").withColumn("linked", F.lit(None).cast("boolean"))
    with_calls = with_calls.withColumn("notes", F.concat(F.coalesce("notes", F.array().cast("array<string>")), "unreadable"))
    results = rows.filter("answers is not null").join(known.withColumnRenamed("id", "answers"), ["conv_id", "answers"], "left")
    results = results.select(
        *rows.columns, F.when(F.col("to_turn").isNotNull(), F.struct("to_turn", F.coalesce("level", F.lit(0)).alias("level"))).alias("at"),
        F.lit(0).cast("long").alias("n_answered"), F.col("to_turn").isNotNull().alias("linked"),
        F.when(F.col("to_turn").isNull(), F.array(F.concat("answers", F.lit(": no call")))).otherwise(F.array().cast("array<string>")).alias("notes"),
    )
    every = plain.unionByName(with_calls.select(plain.columns)).unionByName(results.select(plain.columns))
    return every.select(
        "conv_id", "turn", "role", F.coalesce("at.to_turn", "turn").alias("at_turn"),
        (2 * F.coalesce("at.level", F.lit(0)) + F.when(F.col("answers").isNotNull(), 1).otherwise(0)).cast("long").alias("at_level"),
        F.size("calls").cast("long").alias("n_calls"), F.coalesce("n_answered", F.lit(0)).alias("n_answered"), "linked",
        F.coalesce("notes", F.array().cast("array<string>")).alias("errors"), serialised()("role", "content", "calls", "answers").alias("message"),
    )


def serialised():
    """Column function: (role, content, calls, answers) -> canonical JSON of the message."""

    @F.arrow_udf("string")
    def write(roles: pa.Array, contents: pa.Array, calls: pa.Array, answers: pa.Array) -> pa.Array:
        out = []
        for role, content, made, answer in zip(roles.to_pylist(), contents.to_pylist(), calls.to_pylist(), answers.to_pylist()):
            message: dict[str, Any] = {"role": role, "content": content}
            if made:
                message["tool_calls"] = [{"id": c["id"], "name": c["name"], "arguments": json.loads(c["arguments"])} for c in made]
            if answer is not None:
                message["tool_call_id"] = answer
            out.append(canonical(message))
        return pa.array(out, pa.string())

    return write
