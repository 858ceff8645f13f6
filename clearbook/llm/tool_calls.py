"""Tool-call linking: calls and results joined by identifier, put in topological order, validated, as canonical JSON.

A call may name another call whose result it builds on. Its place is ``(order_turn, depth, turn, call_id)`` within its
conversation: the latest turn on its path of parents, and the number of them. A parent always comes before its children and
a call before its result, also where a log holds them the other way round. The paths are followed by pointer doubling, a
join per doubling, so a conversation of any length needs few rounds and is never gathered in one task.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.shared import batches, drop_kept, keep


def _pairs(pairs: list[tuple[str, object]]) -> dict:
    made = dict(pairs)
    if len(made) < len(pairs):
        raise ValueError("repeated name")
    return made


def _constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def read_json(text: str) -> object:
    """Strict JSON: no repeated names, no NaN or infinities."""
    return json.loads(text, object_pairs_hook=_pairs, parse_constant=_constant)


def _number(value: float) -> str:
    """A float in the shortest form that reads back, without exponent between 1e-6 and 1e21."""
    if not math.isfinite(value):
        raise ValueError("number out of range")
    if value == 0:
        return "0"
    if value == int(value) and abs(value) < 1e21:
        return str(int(value))
    digits = repr(value)
    mantissa, _, exponent = digits.partition("e")
    if not exponent:
        return digits
    power = int(exponent)
    if -7 < power < 0:
        sign, bare = ("-", mantissa[1:]) if mantissa[0] == "-" else ("", mantissa)
        return f"{sign}0.{'0' * (-power - 1)}{bare.replace('.', '')}"
    return f"{mantissa}e{'+' if power > 0 else '-'}{abs(power)}"


def canonical(value: object) -> str:
    """JSON without blanks, names in the order of their UTF-16 code units, shortest numbers, text as it is."""
    if isinstance(value, dict):
        names = sorted(value, key=lambda name: name.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{json.dumps(n, ensure_ascii=False)}:{canonical(value[n])}" for n in names) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    return _number(value) if isinstance(value, float) else json.dumps(value, ensure_ascii=False)


# The type names of JSON Schema.
TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and v == int(v),
}


def violations(value: object, schema: Mapping, at: str = "$") -> list[str]:
    """What breaks a schema of types, enum, bounds, required, properties, additionalProperties and items."""
    wanted = schema.get("type")
    if wanted is not None:
        names = [wanted] if isinstance(wanted, str) else wanted
        if not any(TYPES[name](value) for name in names):
            return [f"{at}: not of type {'|'.join(names)}"]
    found = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        found.append(f"{at}: not in enum")
    size = len(value) if isinstance(value, (str, list)) else value if TYPES["number"](value) else None
    kind = "Length" if isinstance(value, str) else "Items" if isinstance(value, list) else "imum"
    if size is not None:
        if size < schema.get(f"min{kind}", -math.inf):
            found.append(f"{at}: below min{kind}")
        if size > schema.get(f"max{kind}", math.inf):
            found.append(f"{at}: above max{kind}")
    if isinstance(value, dict):
        properties = schema.get("properties", {})
        found += [f"{at}.{name}: missing" for name in schema.get("required", ()) if name not in value]
        for name in sorted(value):
            if name in properties:
                found += violations(value[name], properties[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{name}: not allowed")
    if isinstance(value, list) and "items" in schema:
        found += [x for i, item in enumerate(value) for x in violations(item, schema["items"], f"{at}[{i}]")]
    return found


def topological(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, order_turn, depth, cyclic) of calls with one row an id (conv_id, call_id, turn, parent_id).

    A parent that is not there ends a path like none. Calls on a cycle, or behind one, are marked and have depth -1.
    """
    names = calls.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("there"))
    known = calls.join(names, ["conv_id", "parent_id"], "left")
    state = known.select(
        "conv_id", "call_id", F.when(F.col("there"), F.col("parent_id")).alias("up"), F.col("turn").alias("order_turn"),
        F.when(F.col("there"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("depth"),
    )
    state = keep(state, "paths")
    total, seen = state.count(), 1
    while seen <= total and not state.where("up is not null").isEmpty():
        above = state.select(
            "conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("order_turn").alias("up_turn"),
            F.col("depth").alias("up_depth"),
        )
        further = keep(
            state.where("up is not null").join(above, ["conv_id", "up"]).select(
                "conv_id", "call_id", F.col("next").alias("up"), F.greatest("order_turn", "up_turn").alias("order_turn"),
                (F.col("depth") + F.col("up_depth")).alias("depth"),
            ).unionByName(state.where("up is null")),
            "paths",
        )
        drop_kept(state)
        state, seen = further, seen * 2
    cyclic = F.col("up").isNotNull()
    depth = F.when(cyclic, F.lit(-1)).otherwise(F.col("depth")).cast("long")
    return state.select("conv_id", "call_id", "order_turn", depth.alias("depth"), cyclic.alias("cyclic"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """One row for each identifier of a conversation that a call or a result has.

    ``calls`` has conv_id, turn, call_id, name, arguments (JSON text) and parent_id, ``results`` conv_id, turn, call_id and
    content; ``schemas`` maps tool names to JSON schemas and is sent with the function. Of calls, or results, that repeat an
    identifier the first by turn counts, then the smallest; n_calls and n_results say how many there were. Rows with a null
    conv_id or call_id cannot be linked and are left out; other columns are ignored. status is ``linked``, ``unanswered``,
    ``orphan`` (a result without a call) or ``cyclic``; errors lists why arguments are not valid: not JSON, no such tool, or
    what the schema finds. json is the canonical text of the call with its result; arguments that are not JSON stay text.
    """
    keys = ["conv_id", "call_id"]
    asked = calls.where("conv_id is not null and call_id is not null").groupBy(keys).agg(
        F.min(F.struct("turn", "name", "arguments", "parent_id")).alias("call"), F.count("*").alias("n_calls")
    )
    asked = keep(asked.select(*keys, "call.*", "n_calls"), "calls")
    answered = results.where("conv_id is not null and call_id is not null").groupBy(keys).agg(
        F.min(F.struct("turn", "content")).alias("result"), F.count("*").alias("n_results")
    )
    placed = asked.join(topological(asked), keys)
    linked = placed.join(answered, keys, "full_outer")
    status = (
        F.when(F.col("n_calls").isNull(), "orphan")
        .when(F.col("cyclic"), "cyclic")
        .when(F.col("n_results").isNull(), "unanswered")
        .otherwise("linked")
    )
    result_turn = F.col("result.turn")
    rows = linked.select(
        *keys, "name", "turn", result_turn.alias("result_turn"), F.coalesce("order_turn", result_turn).alias("order_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), status.alias("status"), "arguments", "parent_id",
        F.col("result.content").alias("content"),
    )
    kept = [(f.name, f.dataType.simpleString()) for f in rows.schema][:10]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    schema = pa.schema(
        [(n, kinds[k]) for n, k in kept] + [("valid", pa.bool_()), ("errors", pa.list_(pa.string())), ("json", pa.string())]
    )

    def serialise(batch: pa.RecordBatch) -> dict:
        out = {name: batch.column(i) for i, (name, _) in enumerate(kept)}
        out |= {"valid": [], "errors": [], "json": []}
        columns = ("call_id", "name", "status", "arguments", "parent_id", "content")
        for call_id, name, status, text, parent, content in zip(*(batch.column(c).to_pylist() for c in columns)):
            record: dict = {"id": call_id, "result": content}
            found = []
            if status != "orphan":
                try:
                    value = read_json(text or "")
                    # As deep as it will stand in the record; half a surrogate pair is no text.
                    canonical({"arguments": value}).encode()
                except (ValueError, RecursionError):
                    value, found = text, ["$: not JSON"]
                if not found:
                    found = violations(value, schemas[name]) if name in schemas else ["$: no such tool"]
                record |= {"name": name, "arguments": value, "parent": parent}
            out["valid"].append(None if status == "orphan" else not found)
            out["errors"].append(found)
            out["json"].append(canonical(record))
        return out

    kind = ", ".join(f"{n} {k}" for n, k in kept) + ", valid boolean, errors array<string>, json string"
    return rows.mapInArrow(batches(serialise, schema), kind)
