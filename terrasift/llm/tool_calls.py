"""Tool-call linking: calls and results hash-joined by identifier, ordered, validated and serialised as canonical JSON.

Order: a call stands at its own (turn, index) unless something it depends on stands there or later; then it moves to that place, behind it: hops
counts how many calls it stands behind there. A call that waits for itself, directly or through others, is in a cycle: it is marked and keeps
its own place, and others see it there. The order is (place_turn, place_index, hops, turn, index); no window over a
conversation is needed, so a conversation of any size is dealt by identifiers.

Only calls connected with a dependency that points forward need work. Their connected components are found by pointer jumping; those of at most
ALONE calls and dependencies are ordered each in one task, by depth-first search. Larger ones are ordered by rounds over written tables: calls
that no longer wait are peeled off, from either end, until only cycles and what lies between them are left, whose parts are told
apart by the least identifiers that reach them and that they reach; then places spread along the dependencies, in as many rounds as the longest chain.

Validation knows type, required, properties, additionalProperties (false), items, enum, minLength and minimum.
Canonical JSON: keys by code point, no blanks, characters as they are (lone surrogates escaped).

Cases: a null or empty text of a call fails minLength. Of results with one identifier the first by (turn, content) is
linked; calls with one identifier are each linked, and stand where the first of them does, or at their own place if that is later. Null identifiers link with
nothing. A missing turn or index counts as 0 where others wait for it. Calls without a result have status ``no_result``, results without a call ``no_call``. Arguments that aren't a JSON object, that
hold NaN or a number beyond doubles, or are nested too deeply for the parser are invalid, and null in the canonical JSON; a schema
of an unknown type lets nothing pass. Other columns are ignored, empty tables give empty results.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, components, cut

#: Calls and dependencies of a connected component that one task orders.
ALONE = 200_000
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical(value) -> str:
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def _finite(text: str) -> float:
    value = float(text)
    if value in (float("inf"), float("-inf")) or value != value:
        raise ValueError(text)
    return value


def parsed(text: str):
    """The value of a JSON text; NaN, infinities and numbers beyond doubles are refused."""
    return json.loads(text, parse_float=_finite, parse_constant=_finite)


def complaint(value, schema: dict, at: str = "$") -> str | None:
    """The first thing in which value doesn't meet the schema."""
    kind = schema.get("type")
    if kind == "integer":
        right = isinstance(value, int) and not isinstance(value, bool)
    elif kind == "number":
        right = isinstance(value, (int, float)) and not isinstance(value, bool)
    else:
        right = kind is None or (kind in _TYPES and isinstance(value, _TYPES[kind]))
    if not right:
        return f"{at}: not {kind}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at}: not in enum"
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        return f"{at}: too short"
    if "minimum" in schema and isinstance(value, (int, float)) and value < schema["minimum"]:
        return f"{at}: too small"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", ()):
            if name not in value:
                return f"{at}.{name}: missing"
        for name in sorted(value):
            if name in known:
                if found := complaint(value[name], known[name], f"{at}.{name}"):
                    return found
            elif schema.get("additionalProperties") is False:
                return f"{at}.{name}: not allowed"
    if isinstance(value, list) and "items" in schema:
        for j, x in enumerate(value):
            if found := complaint(x, schema["items"], f"{at}[{j}]"):
                return found
    return None


def ordered(own: dict, edges: dict) -> dict:
    """{call: (turn, index, hops, cycle)} for calls at own places (turn, index) and what each depends on."""
    number, low, done, stack, parts = {}, {}, set(), [], []
    for root in own:  # strongly connected parts, without recursion
        if root in number:
            continue
        number[root] = low[root] = len(number)
        stack.append(root)
        walk = [(root, iter(edges.get(root, ())))]
        while walk:
            at, rest = walk[-1]
            for to in rest:
                if to not in number:
                    number[to] = low[to] = len(number)
                    stack.append(to)
                    walk.append((to, iter(edges.get(to, ()))))
                    break
                if to not in done:
                    low[at] = min(low[at], number[to])
            else:
                walk.pop()
                if walk:
                    low[walk[-1][0]] = min(low[walk[-1][0]], low[at])
                if low[at] == number[at]:
                    part = []
                    while not part or part[-1] != at:
                        part.append(stack.pop())
                        done.add(part[-1])
                    parts.append(part)
    out = {}
    for part in parts:  # what a part depends on comes before it
        ring = len(part) > 1 or part[0] in edges.get(part[0], ())
        for call in part:
            behind = () if ring else (out[to] for to in edges.get(call, ()))
            out[call] = max([(*own[call], 0), *((t, i, hops + 1) for t, i, hops, _ in behind)]) + (ring,)
    return out


def _by_tasks(edges: DataFrame) -> DataFrame:
    """(call, turn, index, hops, cycle) of the calls of edges (part, a, ta, ia, b, tb, ib: a depends on b), each part in one task."""

    def run(table: pa.Table) -> pa.Table:
        a, ta, ia, b, tb, ib = (table.column(c).to_pylist() for c in ("a", "ta", "ia", "b", "tb", "ib"))
        own = dict(zip(b, zip(tb, ib))) | dict(zip(a, zip(ta, ia)))
        on: dict = {}
        for x, y in zip(a, b):
            on.setdefault(x, []).append(y)
        found = ordered(own, on)
        columns = list(zip(*((call, *place) for call, place in found.items())))
        return pa.table({name: pa.array(x, kind) for name, x, kind in zip(("call", "turn", "index", "hops", "cycle"), columns, (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()))})

    return edges.groupBy("part").applyInArrow(run, "call string, turn long, index int, hops int, cycle boolean")


def _peeled(edges: DataFrame) -> DataFrame:
    """The edges (a, b) on cycles or on ways between cycles: calls without a way on are taken off, from either end."""
    while True:
        kept = edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        kept = cut(kept.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a", "b"), "call-peeled")
        if kept.count() == edges.count():
            return kept
        edges = kept


def _least_reaching(edges: DataFrame, forward: bool) -> DataFrame:
    """(call, least): the least call from which it can be reached, itself included, along the edges or against them."""
    to, by = ("b", "a") if forward else ("a", "b")
    least = cut(edges.select(F.col("a").alias("call")).union(edges.select("b")).distinct().withColumn("least", F.col("call")), "call-least")
    while True:
        passed = edges.join(least.withColumnsRenamed({"call": by, "least": "l"}), by).groupBy(F.col(to).alias("call")).agg(F.min("l").alias("l"))
        step = least.join(passed, "call", "left").select("call", F.least("least", "l").alias("least"), (F.col("l") < F.col("least")).alias("moved"))
        step = cut(step, "call-least")
        least = step.select("call", "least")
        if step.where("moved").isEmpty():
            return least


def _on_cycles(edges: DataFrame) -> DataFrame:
    """(call) of the calls on cycles of edges (a, b)."""
    found = edges.where("a = b").select(F.col("a").alias("call")).distinct()
    rest = _peeled(edges.where("a != b"))
    while not rest.isEmpty():
        down, up = _least_reaching(rest, True), _least_reaching(rest, False)
        both = cut(down.join(up.withColumnRenamed("least", "up"), "call"), "call-both")
        # calls that one call reaches and that reach it are one part with it; the edges within one pair of least calls can hold others
        parts = both.where("least = up").groupBy("least").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        ring = cut(both.where("least = up").join(parts, "least").select("call"), "call-ring")
        found = found.union(ring)
        side = lambda x: both.select(F.col("call").alias(x), F.struct("least", "up").alias(f"k{x}"), (F.col("least") == F.col("up")).alias(f"d{x}"))
        inside = rest.join(side("a"), "a").join(side("b"), "b").where("ka = kb and not da and not db").select("a", "b")
        rest = _peeled(cut(inside, "call-inside"))
    return found.distinct()


def _by_rounds(edges: DataFrame) -> DataFrame:
    """As _by_tasks(), for parts of any size."""
    cycles = cut(_on_cycles(edges.select("a", "b")), "call-cycles").withColumn("cycle", F.lit(True))
    calls = edges.select(F.col("a").alias("call"), F.col("ta").alias("t"), F.col("ia").alias("i")).union(edges.select("b", "tb", "ib")).distinct()
    keys = calls.join(cycles, "call", "left").select("call", F.struct("t", "i", F.lit(0).alias("hops")).alias("key"), F.coalesce("cycle", F.lit(False)).alias("cycle"))
    keys = cut(keys, "call-keys")
    waits = cut(edges.select("a", "b").join(cycles.select(F.col("call").alias("a")), "a", "left_anti"), "call-waits")  # a call on a cycle stays
    while True:
        behind = waits.join(keys.select(F.col("call").alias("b"), F.col("key").alias("k")), "b").select(F.col("a").alias("call"), F.struct(F.col("k.t").alias("t"), F.col("k.i").alias("i"), (F.col("k.hops") + 1).alias("hops")).alias("k"))
        step = keys.join(behind.groupBy("call").agg(F.max("k").alias("k")), "call", "left")
        step = cut(step.select("call", F.greatest("key", "k").alias("key"), "cycle", (F.col("k") > F.col("key")).alias("moved")), "call-keys")
        keys = step.drop("moved")
        if step.where("moved").isEmpty():
            return keys.select("call", F.col("key.t").alias("turn"), F.col("key.i").alias("index"), F.col("key.hops").alias("hops"), "cycle")


def placed(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, turn, index, name, arguments and depends_on of calls, with place_turn, place_index, hops and cycle."""
    calls = calls.select("conv_id", "call_id", "turn", "index", "name", "arguments", "depends_on")
    named = calls.where("conv_id is not null and call_id is not null")
    name = F.to_json(F.struct(F.col("conv_id").cast("string").alias("c"), F.col("call_id").cast("string").alias("i")))
    ids = named.groupBy(name.alias("call")).agg(F.min(F.struct(F.coalesce("turn", F.lit(0)).alias("turn"), F.coalesce("index", F.lit(0)).alias("index"))).alias("key")).select("call", F.col("key.turn").alias("t"), F.col("key.index").alias("i"))
    dep = F.to_json(F.struct(F.col("conv_id").cast("string").alias("c"), F.col("dep").cast("string").alias("i")))
    asked = named.select("conv_id", name.alias("a"), F.explode("depends_on").alias("dep")).where("dep is not null").select("a", dep.alias("b")).distinct()
    side = lambda x: ids.select(F.col("call").alias(x), F.col("t").alias(f"t{x}"), F.col("i").alias(f"i{x}"))
    edges = cut(asked.join(side("a"), "a").join(side("b"), "b"), "call-edges")
    late = edges.where("tb > ta or (tb = ta and ib >= ia)")
    still = calls.withColumns({"place_turn": F.col("turn"), "place_index": F.col("index"), "hops": F.lit(0), "cycle": F.lit(False)})
    if late.isEmpty():
        return still
    parts = components(edges.select("a", "b"), "call-parts").withColumnsRenamed({"node": "a", "comp": "part"})
    parted = edges.join(parts, "a", "left").withColumn("part", F.coalesce("part", "a"))  # a call that only depends on itself has no other
    forward = late.select("a").join(parts, "a", "left").select(F.coalesce("part", "a").alias("part")).distinct()
    moved = cut(parted.join(forward, "part"), "call-moved")
    size = moved.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    large = cut(size.where(f"n > {ALONE}").select("part"), "call-large")
    if large.isEmpty():
        found = _by_tasks(moved)
    else:
        found = _by_tasks(moved.join(large, "part", "left_anti")).union(_by_rounds(cut(moved.join(large, "part", "left_semi"), "call-long")))
    found = found.select(F.col("call").alias("_call"), F.struct("turn", "index", "hops").alias("_key"), F.col("cycle").alias("_cycle"))
    own = F.struct("turn", "index", F.lit(0).alias("hops"))
    joined = calls.join(found, name == F.col("_call"), "left").withColumn("_place", F.greatest(own, "_key"))
    return joined.select(*calls.columns, F.col("_place.turn").alias("place_turn"), F.col("_place.index").alias("place_index"), F.col("_place.hops").alias("hops"), F.coalesce("_cycle", F.lit(False)).alias("cycle"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """conv_id, call_id, status, place_turn, place_index, hops, cycle, valid, error, json.

    calls: conv_id, call_id, turn, index, name, arguments (JSON), depends_on (identifiers); results: conv_id, call_id, turn, content.
    """
    arrow_limits(calls.sparkSession)
    one = results.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("r")).select("conv_id", "call_id", F.col("r.turn").alias("result_turn"), F.col("r.content").alias("content"))
    linked = placed(calls).join(one, ["conv_id", "call_id"], "full")
    status = F.when(F.col("name").isNull() & F.col("turn").isNull(), "no_call").when(F.col("result_turn").isNull(), "no_result").otherwise("linked")
    rows = linked.withColumn("status", status).select("conv_id", "call_id", "status", "place_turn", "place_index", "hops", "cycle", "name", "arguments", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid, error, out = [], [], []
            for call_id, status, name, arguments, content in zip(*(batch.column(j).to_pylist() for j in (1, 2, 7, 8, 9))):
                said, value = None, None
                if status != "no_call":
                    try:
                        value = parsed(arguments)
                        said = f"no schema for {name}" if name not in schemas else complaint(value, schemas[name])
                        canonical(value)
                    except (TypeError, ValueError):
                        said, value = "arguments are not JSON", None
                    except RecursionError:
                        said, value = "arguments are nested too deeply", None
                valid.append(None if status == "no_call" else said is None)
                error.append(said and canonical(said)[1:-1])
                out.append(canonical({"id": call_id, "name": name, "arguments": value, "result": content}))
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(valid, pa.bool_()), pa.array(error, pa.string()), pa.array(out, pa.string())], names=[*batch.schema.names[:7], "valid", "error", "json"])

    return rows.mapInArrow(run, "conv_id long, call_id string, status string, place_turn long, place_index int, hops int, cycle boolean, valid boolean, error string, json string")


#: The one tool of plain conversations: a user's turn asks for the next assistant turn.
REPLY = {"type": "object", "required": ["prompt", "turn"], "additionalProperties": False, "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of (conv_id, turn, role, text). Each user turn calls ``reply`` (index 0); a turn with turn % 8 of 2 calls it twice, side by
    side, the second call (index 1) without a result. Each assistant turn is the result of the turn before it.

    Dependencies: of turn % 8 = 0, the call of four turns later; of 2, the call of two turns before, and of its second call the first; of 4, in
    conversations whose number is a multiple of 5, the call of two turns before, which closes a cycle; of 6, the calls of two and of four turns
    before. Turns whose conv_id or turn is null are neither calls nor results.
    """
    there = turns.where("conv_id is not null and turn is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    name = lambda back, more="": F.concat(F.concat_ws("-", "conv_id", F.col("turn") - back), F.lit(more))
    none, at = F.array().cast("array<string>"), F.col("turn") % 8
    waits = F.when(at == 0, F.array(name(-4))).when(at == 2, F.array(name(2))).when((at == 4) & (F.col("conv_id") % 5 == 0), F.array(name(2))).when(at == 6, F.array(name(2), name(4))).otherwise(none)
    one = F.struct(name(0).alias("call_id"), F.lit(0).alias("index"), waits.alias("depends_on"))
    two = F.struct(name(0, "b").alias("call_id"), F.lit(1).alias("index"), F.array(name(0)).alias("depends_on"))
    arguments = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("prompt"), "turn"))
    calls = there.where("role = 'user'").select("conv_id", "turn", arguments.alias("arguments"), F.explode(F.when(at == 2, F.array(one, two)).otherwise(F.array(one))).alias("c"))
    calls = calls.select("conv_id", "c.call_id", "turn", "c.index", F.lit("reply").alias("name"), "arguments", "c.depends_on")
    results = there.where("role = 'assistant'").select("conv_id", name(1).alias("call_id"), "turn", F.coalesce("text", F.lit("")).alias("content"))
    return calls, results
