"""Tool-call linking and canonical chat JSON (operator 3).

A message is (conv_id, turn, role, text).  Its text may be a JSON object that holds
``tool_calls`` (each with id, name, arguments, and ``depends_on``: ids whose results
it needs; arguments may also refer to one as {"$ref": id}) or a ``tool_call_id``
(a result).  Any other text is plain content.

1. Every message is parsed to events: a message, its calls in order, or a result.
2. Calls and results meet in a hash join on (conv_id, call_id): a result belongs to the
   latest call of its id that isn't later, else to the first later one.
3. Events are ordered topologically: a result after its call, a call after the results
   it depends on.  Conversations of at most LOCAL_EDGES dependencies are each ordered
   inside a task.  Of larger ones, runs of events that wait for one other event each are
   contracted by pointer doubling, in a logarithmic number of rounds; what waits for
   several is ordered round by round, until a round adds nothing.  An event's
   ``order_turn`` is the latest turn among itself and what it follows, so (order_turn,
   level, turn, part) sorts a conversation.  Events on a cycle, or after one, have level -1.
4. Arguments are checked against the tool's JSON schema (type, properties, required,
   additionalProperties, enum, items, minimum, maximum).
5. Each event is serialised as canonical JSON: sorted keys, no spaces, UTF-8.

Output is a row for each event, never a conversation in one cell, so a conversation may
hold any share of the rows.  Edge cases: null text is null content; null roles are
kept as null; a null conv_id links nothing; repeated rows give repeated events;
ids that are no strings are compared by their JSON; rows of one turn share their place,
and events of one place their level; text that is no proper JSON (NaN, a
number beyond a double, a nesting too deep for the parser) is plain content; lone
surrogates come out as JSON escapes; of calls of one id and place, and of results, ties
count once; texts of any length are read whole; other columns are not looked at; an
empty table gives none.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Conversations with more dependencies than this are ordered by all tasks together.
LOCAL_EDGES = 20_000
#: After so many rounds their results are written as one table.
COMPACT = 16
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


_LONE = re.compile("[\ud800-\udfff]")


def _escaped(text: str) -> str:
    """text with lone surrogates, which UTF-8 can't hold, as their JSON escapes."""
    return _LONE.sub(lambda m: f"\\u{ord(m.group()):04x}", text)


def canonical(value) -> str:
    return _escaped(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False))


def _no_constant(name: str):
    raise ValueError(f"{name} is no JSON")


def _number(text: str) -> float:
    x = float(text)
    return x if math.isfinite(x) else _no_constant(text)


def loaded(text: str):
    """The JSON value; ValueError for anything else: NaN, Infinity, numbers beyond a double, too deep a nesting."""
    try:
        return json.loads(text, parse_constant=_no_constant, parse_float=_number)
    except RecursionError as e:
        raise ValueError("nested too deep") from e


def _is(value, kind: str) -> bool:
    if kind in ("number", "integer"):
        return isinstance(value, (int, float)) and not isinstance(value, bool) and (kind == "number" or value == int(value))
    return isinstance(value, _TYPES[kind])


def schema_errors(value, schema: dict, at: str = "$") -> list[str]:
    """What in value breaks the schema, in a fixed order."""
    out: list[str] = []
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, kind) for kind in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{at}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{at}: below minimum")
        if value > schema.get("maximum", value):
            out.append(f"{at}: above maximum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if isinstance(value[k], dict) and set(value[k]) == {"$ref"}:
                continue  # filled in when its call has run
            if k in known:
                out += schema_errors(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{k}: unexpected")
    if isinstance(value, list) and "items" in schema:
        for n, x in enumerate(value):
            out += schema_errors(x, schema["items"], f"{at}[{n}]")
    return out


def _references(value) -> Iterator[str]:
    todo = [value]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if set(x) == {"$ref"}:
                yield _id(x["$ref"])
            else:
                todo.extend(x.values())
        elif isinstance(x, list):
            todo.extend(x)


def _id(value) -> str:
    return value if isinstance(value, str) and not _LONE.search(value) else canonical(value)


def events(role: str | None, text: str | None, schemas: dict, tools: bool | None = None) -> list[tuple]:
    """(part, kind, call_id, name, depends_on, errors, json) of each event of a message.

    tools: only calls and results (True), or only the others (False).
    """
    data = None
    if text and text.lstrip()[:1] == "{":
        try:
            data = loaded(text)
            return _events(role, text, data, schemas, tools)
        except (ValueError, RecursionError):
            data = None
    return _events(role, text, data, schemas, tools)


def _events(role: str | None, text: str | None, data, schemas: dict, tools: bool | None) -> list[tuple]:
    if not isinstance(data, dict) or not ("tool_call_id" in data or isinstance(data.get("tool_calls"), list)):
        return [] if tools else [(0, "message", None, None, [], [], canonical({"role": role, "content": text}))]
    if "tool_call_id" in data:
        own = _id(data["tool_call_id"])
        return [] if tools is False else [(0, "result", own, None, [], [], canonical({"role": role, "tool_call_id": own, "content": data.get("content")}))]
    out = [] if tools else [(0, "message", None, None, [], [], canonical({"role": role, "content": data.get("content")}))]
    if tools is False:
        return out
    for part, call in enumerate(data["tool_calls"], 1):
        call = call if isinstance(call, dict) else {}
        inner = call.get("function") if isinstance(call.get("function"), dict) else call
        name, arguments, errors = inner.get("name"), inner.get("arguments", {}), []
        if isinstance(arguments, str):
            try:
                arguments = loaded(arguments)
            except ValueError:
                errors.append("$: not JSON")
        if "id" not in call:
            errors.append("no id")
        if not errors:
            errors = [*map(_escaped, schema_errors(arguments, schemas[name]))] if isinstance(name, str) and name in schemas else [f"unknown tool {canonical(name)}"]
        needs = call.get("depends_on") or []
        needs = sorted({*map(_id, needs if isinstance(needs, list) else [needs]), *_references(arguments)})
        own = _id(call["id"]) if "id" in call else None
        out.append((part, "call", own, _escaped(name) if isinstance(name, str) else canonical(name), needs, errors, canonical({"role": role, "id": own, "name": name, "arguments": arguments})))
    return out


EVENTS = "conv_id bigint, turn bigint, role string, part int, kind string, call_id string, name string, depends_on array<string>, errors array<string>, json string"


def parsed(messages: DataFrame, schemas: dict | None = None, tools: bool | None = None) -> DataFrame:
    """The events of every message, columns of EVENTS; tools: see :func:`events`."""
    schemas = schemas or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.list_(pa.string())
        schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("part", pa.int32()), ("kind", pa.string()), ("call_id", pa.string()), ("name", pa.string()), ("depends_on", texts), ("errors", texts), ("json", pa.string())])
        for b in common.small(batches, 2048):
            rows = []
            for conv, turn, role, text in zip(*(b.column(k).to_pylist() for k in range(4))):
                for part, kind, call_id, name, needs, errors, out in events(role, text, schemas, tools):
                    rows.append((conv, turn, role, part, kind, call_id, name, needs, errors, out))
            if rows:
                yield common.batch(schema, *zip(*rows))

    return messages.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).mapInArrow(run, EVENTS)


def _links(tools: DataFrame) -> DataFrame:
    """(conv_id, call_id, turn, part, call_turn, call_part) of each result and its call."""
    key, at = ["conv_id", "call_id"], F.struct(F.col("turn").alias("t"), F.col("part").alias("p"))
    calls = tools.where("kind = 'call'").select(*key, at.alias("c")).distinct()
    results = tools.where("kind = 'result' and conv_id is not null").select(*key, at.alias("r")).distinct()
    per_id = calls.groupBy(*key).agg(F.min("c").alias("c"), F.count("*").alias("n"))
    one = results.join(per_id.where("n = 1").select(*key, "c"), key)
    # an id that several calls have: one pass over its calls and results in order, never their product
    again = per_id.where("n > 1").select(*key)
    both = calls.select(*key, F.col("c").alias("at"), "c", F.lit(None).cast("struct<t:bigint,p:int>").alias("r")).unionByName(results.select(*key, F.col("r").alias("at"), F.lit(None).cast("struct<t:bigint,p:int>").alias("c"), "r")).join(again, key, "left_semi")
    order = Window.partitionBy(*key).orderBy("at", F.col("c").isNull())
    before, after = F.last("c", True).over(order), F.first("c", True).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    many = both.select(*key, "r", F.coalesce(before, after).alias("c")).where("r is not null")
    return one.select(*key, "r", "c").unionByName(many).select(*key, F.col("r.t").alias("turn"), F.col("r.p").alias("part"), F.col("c.t").alias("call_turn"), F.col("c.p").alias("call_part"))


def _ordered(edges: list[tuple]) -> list[tuple]:
    """(turn, part, level, order_turn) of each event that waits, from (turn, part, from_turn, from_part) of one conversation."""
    after: dict[tuple, list] = {}
    open_: dict[tuple, int] = {}
    for turn, part, from_turn, from_part in edges:
        after.setdefault((from_turn, from_part), []).append((turn, part))
        open_[turn, part] = open_.get((turn, part), 0) + 1
    place = {x: (-1, x[0]) for x in open_}
    ready = [(x, 0, x[0]) for x in after if x not in open_]
    best = {x: (0, x[0]) for x in open_}
    while ready:
        x, level, latest = ready.pop()
        for y in after.get(x, ()):
            best[y] = max(best[y][0], level + 1), max(best[y][1], latest)
            open_[y] -= 1
            if not open_[y]:
                place[y] = best[y]
                ready.append((y, *best[y]))
    return [(*x, *at) for x, at in place.items()]


_PLACES = "conv_id bigint, turn bigint, part int, level bigint, order_turn bigint"


def _local_levels(edges: DataFrame) -> DataFrame:
    """_PLACES of the events that wait; each conversation's edges meet in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int32()), ("level", pa.int64()), ("order_turn", pa.int64())])
        rows: list[tuple] = []
        for conv, own in common.row_groups(batches, "conv_id"):
            found = _ordered([e for b in own for e in zip(*(b.column(k).to_pylist() for k in range(1, 5)))])
            rows += [(int(conv), *x) for x in found]
            if len(rows) >= 4096:
                yield common.batch(schema, *zip(*rows))
                rows = []
        if rows:
            yield common.batch(schema, *zip(*rows))

    dealt = edges.select("conv_id", "turn", "part", "from_turn", "from_part").repartition(common.n_shards(edges), "conv_id").sortWithinPartitions("conv_id")
    return dealt.mapInArrow(run, _PLACES)


def _shared_levels(edges: DataFrame) -> DataFrame:
    """_PLACES of the events that wait, for conversations of any size."""
    node, source = ["conv_id", "turn", "part"], ["conv_id", "from_turn", "from_part"]
    as_source = lambda df, *more: df.select("conv_id", F.col("turn").alias("from_turn"), F.col("part").alias("from_part"), *more)
    waits = common.written(edges.groupBy(*node).agg(F.count("*").alias("n"), F.min("from_turn").alias("from_turn"), F.min("from_part").alias("from_part")), "chat-waits")
    # runs of events that wait for one: where the run starts, how many steps on, the latest turn from there
    runs = common.written(waits.where("n = 1").select(*node, "from_turn", "from_part", F.lit(1).cast("bigint").alias("steps"), F.greatest("turn", "from_turn").alias("latest")), "chat-runs")
    alone = as_source(runs)
    for _ in range(runs.count().bit_length()):
        if runs.join(alone, source, "left_semi").isEmpty():
            break
        on = as_source(runs, F.col("from_turn").alias("_turn"), F.col("from_part").alias("_part"), F.col("steps").alias("_steps"), F.col("latest").alias("_latest"))
        more = F.col("_steps").isNotNull()
        runs = common.written(
            runs.join(on, source, "left").select(
                *node, F.when(more, F.col("_turn")).otherwise(F.col("from_turn")).alias("from_turn"), F.when(more, F.col("_part")).otherwise(F.col("from_part")).alias("from_part"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"), F.greatest("latest", "_latest").alias("latest")
            ),
            "chat-runs",
        )
    # a run that still leads into a run goes round; nothing is ever known of its start
    joints = edges.join(waits.where("n > 1").select(*node), node, "left_semi").select(*node, "from_turn", "from_part")
    start = as_source(runs, F.col("from_turn").alias("_turn"), F.col("from_part").alias("_part"), F.col("steps").alias("_steps"), F.col("latest").alias("_latest"))
    more = F.col("_steps").isNotNull()
    left = joints.join(start, source, "left").select(
        *node, F.when(more, F.col("_turn")).otherwise(F.col("from_turn")).alias("from_turn"), F.when(more, F.col("_part")).otherwise(F.col("from_part")).alias("from_part"), (F.coalesce("_steps", F.lit(0)) + 1).alias("steps"), F.greatest("turn", "from_turn", "_latest").alias("latest")
    )
    left = common.written(left.withColumn("level", F.lit(None).cast("bigint")), "chat-left")
    first = edges.select(*source).distinct().join(as_source(waits), source, "left_anti")
    known = common.written(first.select("conv_id", F.col("from_turn").alias("turn"), F.col("from_part").alias("part"), F.lit(0).cast("bigint").alias("level"), F.col("from_turn").alias("order_turn")), "chat-levels")
    done, n = known, 0
    while not known.isEmpty() and not left.isEmpty():
        got = as_source(known, F.col("level").alias("_level"), F.col("order_turn").alias("_order"))
        met = left.join(got, source, "left").select(*node, "from_turn", "from_part", "steps", F.greatest("latest", "_order").alias("latest"), F.coalesce("level", F.col("_level") + F.col("steps")).alias("level"))
        met = common.written(met, "chat-left")
        ready = met.groupBy(*node).agg(F.count_if(F.col("level").isNull()).alias("open"), F.max("level").alias("level"), F.max("latest").alias("order_turn"))
        known = common.written(ready.where("open = 0").select(*node, "level", "order_turn"), "chat-levels")
        left = common.written(met.join(known.select(*node), node, "left_anti"), "chat-left")
        done, n = done.unionByName(known), n + 1
        if n % COMPACT == 0:
            done = common.written(done, "chat-done")
    done = common.written(done, "chat-done")
    start = as_source(done, F.col("level").alias("_level"), F.col("order_turn").alias("_order"))
    known_start = F.col("_level").isNotNull()
    of_runs = runs.join(start, source, "left").select(*node, F.when(known_start, F.col("_level") + F.col("steps")).otherwise(-1).alias("level"), F.when(known_start, F.greatest("latest", "_order")).otherwise(F.col("turn")).alias("order_turn"))
    of_joints = waits.where("n > 1").select(*node).join(done, node, "left").select(*node, F.coalesce("level", F.lit(-1)).alias("level"), F.coalesce("order_turn", "turn").alias("order_turn"))
    return of_runs.unionByName(of_joints)


def levels(tools: DataFrame, links: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(conv_id, turn, part, level, order_turn) of each call and result; level -1 on a cycle or after one."""
    node = ["conv_id", "turn", "part"]
    after = links.select("conv_id", "turn", "part", F.col("call_turn").alias("from_turn"), F.col("call_part").alias("from_part"))
    first = links.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "part")).alias("r"))
    needs = tools.where("kind = 'call'").select(*node, F.explode("depends_on").alias("call_id")).join(first, ["conv_id", "call_id"])
    edges = after.unionByName(needs.select(*node, F.col("r.turn").alias("from_turn"), F.col("r.part").alias("from_part"))).where("turn is not null and from_turn is not null")
    edges = common.written(edges.distinct(), "chat-edges")
    large = common.written(edges.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > local_edges).select("conv_id"), "chat-large")
    if large.isEmpty():
        places = _local_levels(edges)
    else:  # one in LOCAL_EDGES edges, at most, is a large conversation
        large = F.broadcast(large)
        places = _local_levels(edges.join(large, "conv_id", "left_anti")).unionByName(_shared_levels(common.written(edges.join(large, "conv_id", "left_semi"), "chat-edges")))
    found = tools.select(*node).distinct().join(places, node, "left")
    return found.select(*node, F.coalesce("level", F.lit(0)).cast("int").alias("level"), F.coalesce("order_turn", "turn").alias("order_turn"))


def linked(messages: DataFrame, schemas: dict | None = None) -> DataFrame:
    """Every event with its link, place in the order, validity and canonical JSON.

    Only calls and results are shuffled; other messages wait for nothing and pass by.
    """
    node, none = ["conv_id", "turn", "part"], F.lit(None).cast("bigint")
    plain = parsed(messages, schemas, False).select(*node, "role", "kind", "call_id", "name", F.lit(0).alias("level"), F.col("turn").alias("order_turn"), none.alias("linked_turn"), F.lit(True).alias("valid"), "errors", "json")
    tools = common.written(parsed(messages, schemas, True), "chat-tools")
    if tools.isEmpty():
        return plain
    links = common.written(_links(tools), "chat-links")
    order = levels(tools, links)
    back = links.groupBy("conv_id", "call_id", F.col("call_turn").alias("turn"), F.col("call_part").alias("part")).agg(F.min("turn").alias("linked_turn"))
    other = links.select(*node, "call_id", F.col("call_turn").alias("linked_turn")).unionByName(back)
    out = tools.join(order, node, "left").join(other, [*node, "call_id"], "left")
    alone = (F.col("kind") == "result") & F.col("linked_turn").isNull()
    errors = F.when(alone, F.array_append("errors", F.lit("no such call"))).otherwise(F.col("errors"))
    level = F.coalesce("level", F.lit(0))
    out = out.select(*node, "role", "kind", "call_id", "name", level.alias("level"), F.coalesce("order_turn", "turn").alias("order_turn"), "linked_turn", ((F.size(errors) == 0) & (level >= 0)).alias("valid"), errors.alias("errors"), "json")
    return plain.unionByName(out)


def report(messages: DataFrame, schemas: dict | None = None) -> DataFrame:
    """The events with flat columns."""
    return linked(messages, schemas).select("conv_id", "turn", "part", "role", "kind", "call_id", "level", "order_turn", "linked_turn", "valid", F.size("errors").alias("n_errors"), "json")


#: The catalogue for :func:`with_calls`.
TOOLS = {
    "measure": {
        "type": "object",
        "properties": {"text": {"type": "string"}, "role": {"type": "string", "enum": ["user", "assistant"]}, "turn": {"type": "integer", "minimum": 0}, "last": {"type": ["integer", "null"]}},
        "required": ["text", "turn"],
        "additionalProperties": False,
    },
    "rate": {
        "type": "object",
        "properties": {"score": {"type": "number", "minimum": 0, "maximum": 40}, "tags": {"type": "array", "items": {"type": "string", "enum": ["user", "assistant"]}}},
        "required": ["score", "tags"],
    },
}


def with_calls(messages: DataFrame) -> DataFrame:
    """Every message, and beside it calls of TOOLS, their results and all that can go wrong with them, by fixed rules.

    The message of turn t moves to turn 8t.  At 8t + 1 the assistant calls ``measure`` on
    it; the call's id is c(t), but every fifth turn repeats the id before it.  It refers to
    the result of c(t - 1) and, every fourth turn, also waits for an id that nobody has.
    In every seventh conversation the call of turn 0 waits for that of turn 1, and so goes
    round.  Every third turn the same message holds a second call, ``rate``, its arguments
    as a string, which is cut short every ninth turn; every eleventh conversation calls it
    by a name that isn't in the catalogue.  Roles other than user and assistant break both
    schemas, a null text the first.  The result of ``measure`` comes at 8t + 2, in odd
    turns at 8t + 13, after the next call; that of ``rate`` at 8t + 3; a result that
    belongs to no call at 8t + 4 every sixth turn.
    """
    t, conv = F.col("turn").cast("bigint"), F.col("conv_id").cast("bigint")
    name = lambda n: F.concat(F.lit("c"), n.cast("string"))
    own, last, text_id = name(F.when(t % 5 == 4, t - 1).otherwise(t)), name(t - 1), lambda s: F.concat(F.lit(s), t.cast("string"))
    none = F.lit(None).cast("string")
    needs = F.filter(F.array(F.when(t > 0, last), F.when(t % 4 == 3, F.lit("nobody")), F.when((conv % 7 == 0) & (t == 0), F.lit("c1"))), lambda x: x.isNotNull())
    arguments = F.struct("text", "role", t.alias("turn"), F.when(t > 0, F.create_map(F.lit("$ref"), last)).alias("last"))
    measure = F.to_json(F.struct(own.alias("id"), F.lit("measure").alias("name"), arguments.alias("arguments"), needs.alias("depends_on")))
    rating = F.to_json(F.struct(F.pmod(conv + t, F.lit(50)).alias("score"), F.array("role").alias("tags")))
    rating = F.when(t % 9 == 0, F.regexp_replace(rating, ".$", "")).otherwise(rating)
    called = F.when(conv % 11 == 0, F.lit("appraise")).otherwise(F.lit("rate"))
    rate = F.to_json(F.struct(text_id("r").alias("id"), F.struct(called.alias("name"), rating.alias("arguments")).alias("function")))
    calls = F.concat(F.lit('{"content":null,"tool_calls":['), F.concat_ws(",", measure, F.when(t % 3 == 0, rate).otherwise(none)), F.lit("]}"))
    result = lambda id_, content: F.to_json(F.struct(id_.alias("tool_call_id"), content.alias("content")))
    row = lambda turn, role, text: F.struct(turn.alias("turn"), role.cast("string").alias("role"), text.cast("string").alias("text"))
    tool = F.lit("tool")
    rows = F.array(
        row(8 * t, F.col("role"), F.col("text")),
        row(8 * t + 1, F.lit("assistant"), calls),
        row(8 * t + F.when(t % 2 == 1, 13).otherwise(2), tool, result(own, F.length("text"))),
        F.when(t % 3 == 0, row(8 * t + 3, tool, result(text_id("r"), t))),
        F.when(t % 6 == 5, row(8 * t + 4, tool, result(text_id("x"), t))),
    )
    return messages.select("conv_id", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("m")).select("conv_id", "m.*")
