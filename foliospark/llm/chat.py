"""Tool-call linking: join calls and results, order calls topologically, validate and canonicalise.

DataFrame operations only.  Calls and results meet in an equi-join on (conversation, call id).
A call depends on the calls of its conversation that its arguments name in an ``after`` field
(an id or a list of ids).  Its level is 0 without dependencies, else one more than the
largest level among them; ``position`` numbers the calls of a conversation by (level, turn,
call id).  What is on or behind a cycle gets level null and comes last.

Defined cases: of calls with one (conversation, id) the first by (turn, name, arguments) counts, of
results the first by (turn, content); status is linked, no_result, or early_result when the
first result isn't later than the call; results without a call are listed by
``orphan_results``.  Dependencies on unknown calls or on itself: the first are ignored and listed as
errors, the second is a cycle.  Null conversation or call ids never join: such calls have no
result, no dependencies and no position, and level 0.  Arguments that aren't a JSON object (null, empty and malformed
ones too) give the error ``not an object`` and null canonical arguments.  Extra columns are
ignored; empty tables give empty results.

Canonical JSON: keys sorted, no blanks, and one form for equal numbers: integers keep all their
digits, others are the shortest that give the same double, without exponent from 1e-6 to below
1e21 (100 for 1e2 and 100.0).  Arguments may be of any length.

A conversation may hold a third of all calls: calls are numbered within a level and a run of
``TURNS`` turns, and what comes before such a run is a sum over the runs' counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # string, integer, number, boolean, array, object
    required: bool = False


TURNS = 1000
Schemas = dict[str, tuple[Field, ...]]

SCHEMAS: Schemas = {
    "search": (Field("query", "string", True), Field("limit", "integer", True), Field("after", "string")),
    "lookup": (Field("id", "integer", True), Field("fields", "array"), Field("after", "string")),
    "rate": (Field("score", "number", True), Field("final", "boolean"), Field("after", "string")),
}
#: As above, for the calls of ``calls_of_conversations``, which name several calls.
TOOLS: Schemas = {name: (*fields[:-1], Field("after", "array")) for name, fields in SCHEMAS.items()}
#: Names that schema_of_variant gives to the values of each kind.
_KINDS = {"string": "^STRING$", "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": "^BOOLEAN$", "array": "^ARRAY<", "object": "^OBJECT<"}


def _errors(name: Column, schemas: Schemas) -> Column:
    """Errors of the parsed arguments ``v``, in the order of the schema, then unknown keys."""
    out = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))
    for tool, fields in schemas.items():
        tests = []
        for f in fields:
            kind = F.expr(f"schema_of_variant(try_variant_get(v, '$.{f.name}', 'variant'))")
            missing = F.lit(f"{f.name} is missing") if f.required else F.lit(None).cast("string")
            tests.append(F.when(~F.coalesce(F.array_contains("keys", f.name), F.lit(False)), missing).when(~F.coalesce(kind.rlike(_KINDS[f.kind]), F.lit(False)), F.lit(f"{f.name} is not {f.kind}")))
        extra = F.transform(F.array_sort(F.array_except("keys", F.array(*[F.lit(f.name) for f in fields]))), lambda k: F.concat(k, F.lit(" is unknown")))
        out = F.when(name == tool, F.concat(F.array_compact(F.array(*tests)), extra)).otherwise(out)
    return F.when(F.col("keys").isNull(), F.array(F.lit("not an object"))).otherwise(out)


def _number(x: Column) -> Column:
    """The canonical form of a number, from its JSON text."""
    d = x.try_cast("double")
    size = F.abs(d)
    text = d.cast("string")
    plain = F.when(size < 1, d.cast("string").try_cast("decimal(38,28)").cast("string")).otherwise(text.try_cast("decimal(38,18)").cast("string"))
    plain = F.regexp_replace(plain, r"\.?0+$", "")
    far = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), "E(?=[0-9])", "e+"), "E-", "e-")
    return (
        F.when(x.rlike(r"^-?[0-9]+$"), F.when(x == "-0", "0").otherwise(x))
        .when(d == 0, "0")
        .when((size < 1e21) & (d == F.rint(d)), text.try_cast("decimal(38,0)").cast("string"))
        .when((size >= 1e-6) & (size < 1e21), plain)
        .otherwise(far)
    )


def canonical(json: Column) -> Column:
    """The JSON of a variant (sorted, without blanks) with its numbers in canonical form; strings stay as they are."""
    parts = F.regexp_extract_all(json, F.lit(r'("[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.eE+-]*+|[^"0-9-]++)'), 1)
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^[-0-9]"), _number(x)).otherwise(x)), "")


def link(calls: DataFrame, results: DataFrame, schemas: Schemas | None = None) -> DataFrame:
    """calls: conv_id, turn, call_id, name, arguments; results: conv_id, turn, call_id, content.

    A row a call: conv_id, call_id, turn, name, status, result_turn, content, level, position,
    valid, errors, arguments (canonical JSON).
    """
    schemas = SCHEMAS if schemas is None else schemas
    key = ["conv_id", "call_id"]
    no_id = "conv_id is null or call_id is null"
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments")
    first = calls.where(f"not ({no_id})").groupBy(*key).agg(F.min(F.struct("turn", "name", "arguments")).alias("c")).select(*key, "c.*")
    calls = first.unionByName(calls.where(no_id).select(*key, "turn", "name", "arguments"))
    calls = calls.withColumn("keys", F.when(F.json_object_keys("arguments").isNotNull(), F.json_object_keys("arguments"))).withColumn("v", F.expr("try_parse_json(arguments)"))
    calls = calls.withColumn("keys", F.when(F.col("v").isNotNull(), F.col("keys")))
    calls = calls.select(
        *key,
        "turn",
        "name",
        F.coalesce(F.expr("try_variant_get(v, '$.after', 'array<string>')"), F.array_compact(F.array(F.expr("try_variant_get(v, '$.after', 'string')"))), F.array().cast("array<string>")).alias("after"),
        _errors(F.col("name"), schemas).alias("errors"),
        F.when(F.col("keys").isNotNull(), canonical(F.to_json("v"))).alias("arguments"),
    )
    calls = materialize(calls, "chat-calls", merge=False)

    # Hash join of calls and first results.
    first = results.select("conv_id", "turn", "call_id", "content").groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("r"))
    linked = calls.join(first.hint("shuffle_hash"), key, "left")
    status = F.when(F.col("r").isNull(), "no_result").when(F.col("r.turn") > F.col("turn"), "linked").otherwise("early_result")

    levels, unknown = _levels(calls)
    out = linked.join(_positions(calls, levels), key, "left").join(unknown, key, "left")
    errors = F.concat("errors", F.coalesce("unknown", F.array().cast("array<string>")))
    return out.select(
        *key,
        "turn",
        "name",
        status.alias("status"),
        F.col("r.turn").alias("result_turn"),
        F.col("r.content").alias("content"),
        F.when(F.expr(no_id), F.lit(0)).otherwise(F.col("level")).alias("level"),
        "position",
        (F.size(errors) == 0).alias("valid"),
        errors.alias("errors"),
        "arguments",
    )


def _positions(calls: DataFrame, levels: DataFrame) -> DataFrame:
    """conv_id, call_id, level, position, of calls with ids."""
    key = ["conv_id", "call_id"]
    rows = calls.where("conv_id is not null and call_id is not null").select(*key, "turn").join(levels, key, "left")
    rows = materialize(rows.withColumn("rank", F.coalesce("level", F.lit(2**31 - 1))).withColumn("run", F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(2**62)))), "chat-order", merge=False)
    run = ["conv_id", "rank", "run"]
    counts = rows.groupBy(*run).agg(F.count("*").alias("n"))
    before = W.partitionBy("conv_id").orderBy("rank", "run").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("conv_id", "rank", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy(*run).orderBy("turn", "call_id"))
    met = rows.withColumn("inside", inside).join(counts, ["conv_id", "rank", "run"])
    return met.select(*key, "level", (F.col("before") + F.col("inside")).cast("int").alias("position"))


def _levels(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, call_id, level) of the calls off cycles, and their dependencies on unknown calls.

    Calls with one dependency point to it, and pointers are doubled until they reach a call with
    none or several: a chain of n calls takes log n rounds.  Only calls with several
    dependencies are then settled level by level.
    """
    key = ["conv_id", "call_id"]
    own = calls.where("conv_id is not null and call_id is not null").select(*key, "after")
    edges = own.select(*key, F.explode(F.array_distinct("after")).alias("needs"))
    known = own.select("conv_id", F.col("call_id").alias("needs"), F.lit(True).alias("known"))
    edges = materialize(edges.join(known, ["conv_id", "needs"], "left"), "chat-edges", merge=False)
    unknown = edges.where("known is null").groupBy(*key).agg(F.array_sort(F.collect_set(F.concat("needs", F.lit(" is an unknown call")))).alias("unknown"))
    edges = edges.where("known").drop("known")
    degree = materialize(edges.groupBy(*key).agg(F.count("*").alias("n"), F.min("needs").alias("to")), "chat-degrees", merge=False)
    free = own.join(degree, key, "left_anti").select(*key, F.lit(0).cast("long").alias("level"))
    to_end = _jump(degree.where("n = 1").select(*key, "to"))

    # Dependencies of calls with several: the end of the chain and how far it is; none for a chain into a cycle.
    several = edges.join(degree.where("n > 1").select(*key), key, "left_semi")
    at = to_end.select("conv_id", F.col("call_id").alias("needs"), F.when(F.col("ends"), F.col("to")).alias("to"), "far")
    single = F.col("far").isNotNull()
    waiting = several.join(at, ["conv_id", "needs"], "left").select(*key, F.when(single, F.col("to")).otherwise(F.col("needs")).alias("end"), F.when(single, F.col("far")).otherwise(0).alias("far"), F.lit(None).cast("long").alias("upto"))
    waiting = materialize(waiting, "chat-waiting", merge=False)
    settled = materialize(free, "chat-levels", merge=False)
    parts, newest = [settled], settled
    while waiting.take(1):
        met = newest.select("conv_id", F.col("call_id").alias("end"), "level")
        waiting = waiting.join(met, ["conv_id", "end"], "left").select(*key, "end", "far", F.coalesce("upto", F.col("level") + F.col("far")).alias("upto"))
        waiting = materialize(waiting, "chat-waiting", merge=False)
        newest = waiting.groupBy(*key).agg(F.max("upto").alias("level"), F.count_if(F.col("upto").isNull()).alias("open")).where("open = 0").select(*key, (F.col("level") + 1).alias("level"))
        newest = materialize(newest, "chat-levels", merge=False)
        if not newest.take(1):
            break
        parts.append(newest)
        waiting = waiting.join(newest.select(*key), key, "left_anti")
    ends = parts[0]
    for p in parts[1:]:
        ends = ends.unionByName(p)
    on_chains = to_end.where("ends").join(ends.select("conv_id", F.col("call_id").alias("to"), "level"), ["conv_id", "to"])
    levels = ends.unionByName(on_chains.select(*key, (F.col("level") + F.col("far")).alias("level")))
    return levels.withColumn("level", F.col("level").cast("int")), unknown


def _jump(pointers: DataFrame) -> DataFrame:
    """pointers(conv_id, call_id, to) -> the same with ``to`` moved to the first call that has no pointer, how far that is, and whether it was reached."""
    has = pointers.select("conv_id", F.col("call_id").alias("to"), F.lit(True).alias("on"))
    now = materialize(pointers.join(has, ["conv_id", "to"], "left").select("conv_id", "call_id", "to", F.lit(1).cast("long").alias("far"), F.col("on").isNull().alias("ends")), "chat-pointers", merge=False)
    open_rows = now.where("not ends").count()
    while open_rows:
        step = now.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("to2"), F.col("far").alias("far2"), F.col("ends").alias("ends2"))
        moved = now.where("not ends").join(step, ["conv_id", "to"]).select("conv_id", "call_id", F.col("to2").alias("to"), (F.col("far") + F.col("far2")).alias("far"), F.col("ends2").alias("ends"))
        now = materialize(now.where("ends").unionByName(moved), "chat-pointers", merge=False)
        left = now.where("not ends").count()
        if left == open_rows:  # what no round brings to an end runs into a cycle
            break
        open_rows = left
    return now


def orphan_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose (conversation, id) names no call."""
    return results.join(calls.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti")


def calls_of_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every assistant turn as a call, and results from the other turns.

    All follows from the turn's text: its length chooses the tool, the calls that this one comes after
    (the last one, the third last, itself, an unknown one, or none), how a number is written and
    whether the arguments break the schema.  The turn after a call has its result; some turns
    have one of the call that only comes next.
    """
    n = F.length(F.coalesce("text", F.lit("")))
    ident = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    said = turns.where("role = 'assistant'").select("conv_id", "turn", ident(F.col("turn")).alias("call_id"), n.alias("n"))
    order = W.partitionBy("conv_id").orderBy("turn")
    said = said.withColumn("last", F.lag("call_id").over(order)).withColumn("third", F.lag("call_id", 3).over(order))
    needs = F.array_compact(F.array(F.when(F.col("n") % 5 != 0, F.col("last")), F.when(F.col("n") % 2 == 0, F.col("third")), F.when(F.col("n") % 17 == 0, F.col("call_id")), F.when(F.col("n") % 19 == 0, F.concat(F.lit("x"), F.col("call_id")))))
    after = F.when(F.size(needs) > 0, F.concat(F.lit(', "after": ["'), F.array_join(needs, '", "'), F.lit('"]'))).otherwise("")
    search = F.concat(F.lit('{"query": "q'), F.col("n"), F.lit('", "limit": '), F.when(F.col("n") % 11 == 0, F.lit('"ten"')).otherwise(F.lit("10")), after, F.lit("}"))
    lookup = F.concat(F.lit('{"id": '), F.col("n"), after, F.when(F.col("n") % 13 == 0, ', "depth": 2').otherwise(', "fields": ["b", "a"]'), F.lit("}"))
    score = F.when(F.col("n") % 4 == 0, "5e-1").when(F.col("n") % 4 == 1, "0.50").when(F.col("n") % 4 == 2, "1e2").otherwise("100.0")
    rate = F.concat(F.lit("{"), F.when(F.col("n") % 7 == 0, '"final": true').otherwise(F.concat(F.lit('"score": '), score, F.lit(', "final": false'))), after, F.lit("}"))
    tool = F.when(F.col("n") % 3 == 0, "search").when(F.col("n") % 3 == 1, "lookup").otherwise("rate")
    calls = said.select("conv_id", "turn", "call_id", tool.alias("name"), F.when(F.col("n") % 3 == 0, search).when(F.col("n") % 3 == 1, lookup).otherwise(rate).alias("arguments"))
    others = turns.where("role <> 'assistant'")
    results = others.where("turn > 0").select("conv_id", "turn", ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    early = others.where(n % 10 == 3).select("conv_id", "turn", ident(F.col("turn") + 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results.unionByName(early)
