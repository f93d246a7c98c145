"""Chat formatting: tool calls meet their results, are put in dependency order, checked and written as canonical JSON.

Calls (conv_id, call_id, position, name, arguments: JSON text, depends_on: array of call ids) join results (conv_id,
call_id, content) by identifier in a shuffled hash join: both sides hold an identifier once by then, so no hash bucket is
hot. Schemas (name, required: map of argument -> JSON type, optional: the same) are a table too and join by tool name.

Order: a call's `level` is the length of the longest chain of dependencies behind it, so (level, position) is a
topological order of its conversation. Conversations of up to `most` calls and dependencies stream past, sorted, and
each is ordered when it ends (Kahn's algorithm), in one job. Longer ones, which no task may hold, are ordered by joins:

1. Calls with one dependency point at it; pointers are doubled until each reaches a call with none or several.
2. Calls with several dependencies, joined to the ends of such chains, get levels in rounds: when all that they wait for
   have one. Chains take no rounds of their own, so rounds are as many as such calls follow each other.

Calls of a cycle, and those that wait for one, get no level and are marked.

Checks, each a name in `problems`: bad_json (arguments are not one JSON object), unknown_tool, missing:<argument>,
type:<argument>, unexpected:<argument>, unknown_dependency, cycle, no_result. Canonical JSON: keys sorted by code point,
no blanks, non-ASCII kept, numbers as Python's json reads and writes them.

Defined results: rows with a null conv_id or call_id are left out; a repeated call (equal conv_id and call_id) counts
once, the row of the least position, name and arguments; of several results of a call the least content stands, and
`n_results` tells how many there were; results without a call are listed by `orphans`; null arguments are bad_json, and so are those nested deeper than Python's parser goes; null
dependencies are none; very long arguments are parsed whole, one call at a time; empty tables give empty results; extra
columns are left out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import discard, fields, parallelism, shape, slices, written

_KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}
KEY = ["conv_id", "call_id"]


def canonical(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def _not_json(name: str) -> None:
    raise ValueError(name)


def check_arguments(arguments: str | None, known: bool, required: dict[str, str], optional: dict[str, str]) -> tuple[str | None, list[str]]:
    """Canonical arguments (null if they are no JSON object) and the problems found."""
    try:
        value = json.loads(arguments, parse_constant=_not_json)
        text = canonical(value)
    except (TypeError, ValueError, RecursionError):
        return None, ["bad_json"] + ([] if known else ["unknown_tool"])
    if not isinstance(value, dict):
        return None, ["bad_json"] + ([] if known else ["unknown_tool"])
    if not known:
        return text, ["unknown_tool"]
    out = [f"missing:{k}" for k in sorted(required) if k not in value]
    for k in sorted(value):
        kind = required.get(k) or optional.get(k)
        if kind is None:
            out.append(f"unexpected:{k}")
        elif not isinstance(value[k], _KINDS.get(kind, object)) or (isinstance(value[k], bool) and kind in ("integer", "number")):
            out.append(f"type:{k}")
    return text, out


def ordered(needs: dict[str, list[str]]) -> dict[str, int]:
    """The levels of a conversation's calls by what each needs (calls only, each once); calls on or behind a cycle have none."""
    waits = {c: len(n) for c, n in needs.items()}
    after: dict[str, list[str]] = {}
    for c, own in needs.items():
        for n in own:
            after.setdefault(n, []).append(c)
    level = {c: 0 for c, n in waits.items() if not n}
    ready = list(level)
    for c in ready:  # grows as calls get ready; what makes one ready last has the highest level
        for later in after.get(c, ()):
            waits[later] -= 1
            if not waits[later]:
                level[later] = level[c] + 1
                ready.append(later)
    return level


#: A task holds one conversation of so many calls and dependencies, at most.
MOST = 100_000


def levels(calls: DataFrame, most: int = MOST) -> DataFrame:
    """calls (conv_id, call_id, depends_on) -> conv_id, call_id, level (null: on or behind a cycle), n_known (dependencies that are calls)."""
    calls = calls.select(*KEY, "depends_on")
    weight = F.sum(F.greatest(F.size("depends_on"), F.lit(0)) + 1)
    large = written(calls.groupBy("conv_id").agg(weight.alias("n")).where(F.col("n") > most).select("conv_id"))
    kinds = shape(*((c, calls.schema[c].dataType) for c in KEY), ("level", "int"), ("n_known", "bigint"))

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held = None, {}

        def finished() -> pa.RecordBatch:
            needs = {c: [n for n in dict.fromkeys(own or ()) if n in held] for c, own in held.items()}
            level = ordered(needs)
            columns = [[conv] * len(held), list(held), [level.get(c) for c in held], [len(needs[c]) for c in held]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=kinds.names)

        for part in slices(batches, 1024):
            types = [part.schema.field(0).type, part.schema.field(1).type, pa.int32(), pa.int64()]
            for c, call, needs in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                if c != conv:
                    if held:
                        yield finished()
                    conv, held = c, {}
                held[call] = needs
        if held:
            yield finished()

    small = calls.join(large, "conv_id", "left_anti").repartition(parallelism(calls.sparkSession), "conv_id").sortWithinPartitions(*KEY).mapInArrow(order, kinds)
    if not large.limit(1).count():
        return small
    return small.unionByName(_levels_by_joins(calls.join(large, "conv_id", "left_semi")))


def _levels_by_joins(calls: DataFrame) -> DataFrame:
    """`levels` of conversations of any length; no task holds one."""
    named = lambda frame, name: frame.withColumnRenamed("call_id", name)
    edges = calls.select(*KEY, F.explode(F.array_distinct("depends_on")).alias("needs"))
    edges = written(edges.join(named(calls.select(*KEY), "needs"), ["conv_id", "needs"], "left_semi").select(*KEY, "needs"))
    degree = written(edges.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("needs").alias("up")))

    ups = written(degree.where("n = 1").select(*KEY, "up", F.lit(1).cast("bigint").alias("dist"), F.lit(True).alias("open")))
    longest = calls.groupBy("conv_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(longest.bit_length() + 1):  # what is open then goes round in a cycle
        far = ups.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("dist").alias("more"))
        met = ups.join(far, ["conv_id", "up"], "left")
        last, ups = ups, written(met.select(*KEY, F.coalesce("next", "up").alias("up"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"), F.col("next").isNotNull().alias("open")))
        discard(last)
        if not ups.where("open").limit(1).count():
            break
    chains = ups.where("not open").select(*KEY, "up", "dist")

    has_needs = degree.select(*KEY, F.lit(True).alias("waits"))
    several = edges.join(degree.where("n > 1").select(*KEY), KEY, "left_semi")
    steps = several.join(named(chains, "needs"), ["conv_id", "needs"], "left").select(*KEY, F.coalesce("up", "needs").alias("base"), (F.coalesce("dist", F.lit(0)) + 1).alias("plus"))
    steps = written(steps.join(named(has_needs, "base"), ["conv_id", "base"], "left").select(*KEY, "base", "plus", F.coalesce("waits", F.lit(False)).alias("waits")))
    # the empty start is a table of its own, so that each round may delete the one before
    done, before, count = written(steps.where("false").select(*KEY, F.col("plus").alias("level"))), -1, 0
    while count != before:
        met = steps.join(named(done, "base"), ["conv_id", "base"], "left").withColumn("value", F.when(F.col("waits"), F.col("level") + F.col("plus")).otherwise(F.col("plus")))
        last, done = done, written(met.groupBy(*KEY).agg(F.max("value").alias("level"), F.count("value").alias("m"), F.count("*").alias("n")).where("m = n").select(*KEY, "level"))
        before, count = count, done.count()
        discard(last)

    ends = chains.join(named(has_needs, "up"), ["conv_id", "up"], "left").join(named(done, "up"), ["conv_id", "up"], "left")
    ends = ends.select(*KEY, (F.when(F.col("waits"), F.col("level")).otherwise(F.lit(0)) + F.col("dist")).alias("level"))
    rows = calls.select(*KEY).join(degree.select(*KEY, "n"), KEY, "left").join(ends.unionByName(done), KEY, "left")
    out = written(rows.select(*KEY, F.when(F.col("n").isNull(), F.lit(0)).otherwise(F.col("level")).cast("int").alias("level"), F.coalesce("n", F.lit(0)).alias("n_known")))
    discard(edges, degree, ups, steps, done)
    return out


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call: conv_id, call_id, position, level, name, arguments (canonical), content, n_results, problems, valid, message (canonical JSON)."""
    named = "conv_id is not null and call_id is not null"
    needs = F.array_compact(F.coalesce("depends_on", F.array().cast("array<string>"))).alias("depends_on")
    own = calls.where(named).select(*KEY, F.col("position").cast("bigint").alias("position"), "name", "arguments", needs)
    own = written(own.groupBy(*KEY).agg(F.min(F.struct("position", "name", "arguments", "depends_on")).alias("c")).select(*KEY, "c.*"))
    back = results.where(named).groupBy(*KEY).agg(F.min("content").alias("content"), F.count("*").alias("n_results"))
    rows = own.join(back.hint("shuffle_hash"), KEY, "left").join(levels(own).hint("shuffle_hash"), KEY, "left")
    tools = schemas.where("name is not null").groupBy("name").agg(F.min_by("required", F.to_json("required")).alias("required"), F.min_by("optional", F.to_json("optional")).alias("optional")).withColumn("known", F.lit(True))
    rows = rows.join(tools, "name", "left")
    lost = F.size(F.array_distinct("depends_on")) > F.col("n_known")
    more = F.array_compact(F.array(F.when(lost, F.lit("unknown_dependency")), F.when(F.col("level").isNull(), F.lit("cycle")), F.when(F.col("n_results").isNull(), F.lit("no_result"))))
    empty = F.create_map().cast("map<string,string>")
    frame = rows.select(*KEY, "position", "level", "name", "arguments", "content", F.coalesce("n_results", F.lit(0)).alias("n_results"), more.alias("more"), F.coalesce("known", F.lit(False)).alias("known"), F.coalesce("required", empty).alias("required"), F.coalesce("optional", empty).alias("optional"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.to_pylist(maps_as_pydicts="lossy")
            texts, problems, messages = [], [], []
            for r in rows:
                text, found = check_arguments(r["arguments"], r["known"], r["required"], r["optional"])
                found += r["more"]
                message = {"id": r["call_id"], "name": r["name"], "arguments": json.loads(text) if text else None, "result": r["content"], "valid": not found}
                texts.append(text)
                problems.append(found)
                messages.append(canonical(message))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*KEY, "position", "level", "name")), pa.array(texts, pa.string()), batch.column("content"), batch.column("n_results"), pa.array(problems, pa.list_(pa.string())), pa.array([not p for p in problems]), pa.array(messages, pa.string())], names=[*KEY, "position", "level", "name", "arguments", "content", "n_results", "problems", "valid", "message"])

    kind = lambda c: (c, frame.schema[c].dataType)
    return frame.mapInArrow(check, shape(kind("conv_id"), kind("call_id"), *fields("position bigint, level int"), kind("name"), ("arguments", "string"), kind("content"), *fields("n_results bigint, problems array<string>, valid boolean, message string")))


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose identifier no call has."""
    return results.join(calls.select(*KEY).distinct().hint("shuffle_hash"), KEY, "left_anti")


def calls_of_chat(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chat turns (conv_id, turn, role, text) as calls and results, in fixed shares as they should be and as they should not.

    A user turn is a call of the tool `reply`, a system turn one of `instruct`; an assistant turn is the result of the
    call at the turn before it. What a call needs, by (3 * conv_id + turn) modulo 8: 0-2 the ask before; 3 the two before;
    4 the ask after; 5 the one after and the one before; 6 nothing; 7 the one before and a call that there is not. Arguments, by
    the text's length modulo 10: 1 chars as text, 2 one argument too many, 3 cut JSON, 4 no prompt, 9 a tool that there is not. Results,
    by their length modulo 12: 5 under an identifier that no call has, 7 twice.
    """
    conv, at, text = F.col("conv_id"), F.col("turn").cast("bigint"), F.coalesce("text", F.lit(""))
    name = lambda turn: F.concat(F.lit("call-"), turn.cast("string"))
    size = F.length(text)
    kind, form, fate = F.pmod(conv * 3 + at, F.lit(8)), size % 10, size % 12
    none = F.array().cast("array<string>")
    before = F.when(at >= 2, F.array(name(at - 2))).when(at == 1, F.array(F.lit("call-0"))).otherwise(none)
    needs = (
        F.when(kind <= 2, before)
        .when(kind == 3, F.concat(before, F.when(at >= 4, F.array(name(at - 4))).otherwise(none)))
        .when(kind == 4, F.array(name(at + 2)))
        .when(kind == 5, F.concat(F.array(name(at + 2)), before))
        .when(kind == 7, F.concat(before, F.array(F.lit("call-none"))))
        .otherwise(none)
    )
    prompt, chars = text.alias("prompt"), size.alias("chars")
    arguments = (
        F.when(form == 4, F.to_json(F.struct(chars)))
        .when(form == 1, F.to_json(F.struct(prompt, size.cast("string").alias("chars"))))
        .when(form == 2, F.to_json(F.struct(prompt, chars, F.lit(True).alias("loud"))))
        .when(form == 3, F.lit('{"prompt":'))
        .otherwise(F.to_json(F.struct(prompt, chars)))
    )
    tool = F.when(form == 9, "shout").when(F.col("role") == "user", "reply").otherwise("instruct")
    calls = turns.where(F.col("role").isin("user", "system")).select(conv.cast("string").alias("conv_id"), name(at).alias("call_id"), at.alias("position"), tool.alias("name"), arguments.alias("arguments"), needs.alias("depends_on"))
    own = F.when(fate == 5, F.concat(F.lit("lost-"), at.cast("string"))).otherwise(name(at - 1))
    results = turns.where("role = 'assistant'").select(conv.cast("string").alias("conv_id"), own.alias("call_id"), F.col("text").alias("content"), F.when(fate == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("times"))
    return calls, results.withColumn("time", F.explode("times")).drop("times", "time")
