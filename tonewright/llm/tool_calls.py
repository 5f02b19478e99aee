"""Chat formatting: tool calls linked to their results, ordered, validated and serialised.

Everything is DataFrame work in built-in functions.

*Linking.* Calls and results meet in a hash join on conversation and call id. A result without a
call, a call without a result and a second result for the same call are told apart in ``status``.

*Order.* A call may name calls that it depends on. Its place is ``(order_turn, order_step)``: its own
turn and 0, or, if a call it depends on is not placed before that, that call's place and one step
more. Places are found by joins along the dependencies, and only calls that moved in one round are
followed in the next, so a conversation in the usual order needs a single round whatever its
length. A place with more steps than the conversation has calls can only come from a cycle; such
calls are marked and no longer moved. A conversation is never gathered in one row or task.

*Validation.* Arguments are checked against the properties of the tool: type, required or not, and
unknown names. *Serialisation.* JSON has its keys sorted, no white space, and numbers in one form.

Defined results: null arguments count as ``{}``; text that isn't a JSON object is ``malformed``;
repeated rows of a call with both ids count as one; empty tables give no rows. Of different calls
with the same ids the first by turn, name, arguments and dependencies is linked, the others are rows
with the status ``conflict``. Calls and results with a null id link with nothing: ``format_all`` gives
each a row with the status ``no id``, and ``format_turns`` each turn with a null role one with ``no role``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonewright.sources.workspace import materialize

#: Type names of schemas and what they accept, as prefixes of Spark's names.
TYPES = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
    "null": ("VOID",),
}
_KEY = ["conv_id", "call_id"]
_NAMED = "conv_id IS NOT NULL AND call_id IS NOT NULL"
_COLUMNS = ["turn", "name", "arguments", "depends_on"]


def canonical(json: Column) -> Column:
    """JSON with sorted keys and no white space; null if it can't be read."""
    return F.to_json(F.try_parse_json(json))


def _content() -> Column:
    return F.struct(*_COLUMNS)


def conflicts(calls: DataFrame) -> DataFrame:
    """Different calls with ids that another one before them has; a row for each."""
    both = calls.where(_NAMED).groupBy(*_KEY).agg(F.min(_content()).alias("first"), F.max(_content()).alias("last"))
    several = both.where("NOT (first <=> last)").select(*_KEY, "first")
    others = calls.join(several, _KEY).where(~_content().eqNullSafe(F.col("first")))
    return others.select(calls.columns).dropDuplicates()


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls with ``result``, ``result_turn`` and ``status``: linked, repeated, early, unanswered or
    orphan. The first result by turn counts; ``early`` results stand before their call."""
    asked = calls.where(_NAMED).groupBy(*_KEY).agg(F.min(_content()).alias("call")).select(*_KEY, "call.*")
    known = results.where(_NAMED)
    first = known.groupBy(*_KEY).agg(
        F.min(F.struct("result_turn", "result")).alias("first"),
        F.countDistinct("result_turn", "result").alias("answers"),
    )
    met = asked.join(first, _KEY, "full_outer")
    status = (
        F.when(F.col("turn").isNull(), "orphan")
        .when(F.col("answers").isNull(), "unanswered")
        .when(F.col("first.result_turn") < F.col("turn"), "early")
        .when(F.col("answers") > 1, "repeated")
        .otherwise("linked")
    )
    return met.select(
        *asked.columns, F.col("first.result_turn").alias("result_turn"), F.col("first.result").alias("result"),
        status.alias("status"),
    )


def order(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, order_turn, order_step, in_cycle`` from ``turn`` and ``depends_on``.

    Names of calls that don't exist are ignored. Sorting a conversation by the place and the call
    id puts each call behind all that it depends on.
    """
    base = calls.where("turn IS NOT NULL").select(*_KEY, "turn", "depends_on")
    sizes = base.groupBy("conv_id").agg(F.count("*").alias("calls"))
    edges = base.select(*_KEY, F.explode(F.array_distinct("depends_on")).alias("parent"))
    edges = materialize(edges.where("parent IS NOT NULL"), "dependencies")
    start = F.struct(F.col("turn").cast("bigint").alias("turn"), F.lit(0).cast("bigint").alias("step"))
    places = materialize(base.select(*_KEY, start.alias("at"), F.lit(False).alias("in_cycle")), "places")
    moved = places
    while True:
        parents = moved.where("NOT in_cycle").select("conv_id", F.col("call_id").alias("parent"), F.col("at").alias("before"))
        after = F.struct(F.col("before.turn").alias("turn"), (F.col("before.step") + 1).alias("step"))
        least = edges.join(parents, ["conv_id", "parent"]).groupBy(*_KEY).agg(F.max(after).alias("least"))
        late = places.join(least, _KEY).where("least > at").join(sizes, "conv_id")
        late = late.select(*_KEY, F.col("least").alias("at"), (F.col("least.step") >= F.col("calls")).alias("in_cycle"))
        late = materialize(late, "moved")
        if late.isEmpty():
            return places.select(
                *_KEY, F.col("at.turn").alias("order_turn"), F.col("at.step").alias("order_step"), "in_cycle"
            )
        new = late.select(*_KEY, F.col("at").alias("new_at"), F.col("in_cycle").alias("new_cycle"))
        places = materialize(
            places.join(new, _KEY, "left").select(
                *_KEY, F.coalesce("new_at", "at").alias("at"), F.coalesce("new_cycle", "in_cycle").alias("in_cycle")
            ),
            "places",
        )
        moved = late


def validate(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``conv_id, call_id, errors``: sorted texts, empty if the arguments fit their tool.

    ``schemas`` has ``name, property, type, required``, a row for each property of each tool; a tool
    without properties has one row with a null property.
    """
    parsed = calls.where("turn IS NOT NULL").select(
        *_KEY, "name", F.try_parse_json(F.coalesce("arguments", F.lit("{}"))).alias("value")
    )
    is_object = F.coalesce(F.schema_of_variant("value").startswith("OBJECT"), F.lit(False))
    checked = parsed.select(*_KEY, "name", is_object.alias("is_object"), "value")
    fields = F.when(F.col("is_object"), F.expr("cast(value AS map<string, variant>)"))
    given = checked.select(*_KEY, "name", F.explode(fields).alias("property", "value")).select(
        *_KEY, "name", "property", F.schema_of_variant("value").alias("got")
    )
    tools = F.broadcast(schemas.select("name").distinct()) if _small(schemas) else schemas.select("name").distinct()
    properties = schemas.where("property IS NOT NULL").select("name", "property", "type", "required")
    right = F.lit(False)
    for kind, prefixes in TYPES.items():
        fits = F.lit(False)
        for prefix in prefixes:
            fits = fits | F.col("got").startswith(prefix)
        right = right | ((F.col("type") == kind) & fits)
    wrong = (
        given.join(properties, ["name", "property"], "left")
        .select(
            *_KEY,
            F.when(F.col("type").isNull(), F.concat(F.lit("unknown "), "property"))
            .when(~right, F.concat(F.lit("type "), "property"))
            .alias("error"),
        )
        .where("error IS NOT NULL")
    )
    needed = checked.where("is_object").select(*_KEY, "name").join(properties.where("required"), "name")
    missing = needed.join(given.select(*_KEY, "name", "property"), [*_KEY, "name", "property"], "left_anti").select(
        *_KEY, F.concat(F.lit("missing "), "property").alias("error")
    )
    broken = checked.where("NOT is_object").select(*_KEY, F.lit("malformed").alias("error"))
    strange = checked.join(tools, "name", "left_anti").select(*_KEY, F.lit("tool").alias("error"))
    errors = wrong.unionByName(missing).unionByName(broken).unionByName(strange)
    listed = errors.groupBy(*_KEY).agg(F.array_sort(F.collect_set("error")).alias("errors"))
    none = F.array().cast("array<string>")
    return checked.select(*_KEY).join(listed, _KEY, "left").select(*_KEY, F.coalesce("errors", none).alias("errors"))


def _small(schemas: DataFrame) -> bool:
    """Whether the schemas have few enough rows to be sent to all tasks."""
    return schemas.limit(10_001).count() <= 10_000


def serialise(name: Column, call_id: Column, arguments: Column, result: Column) -> Column:
    """A call and its result as one canonical JSON object; arguments that can't be read are a
    string, a missing result is null."""
    text = lambda c: F.when(c.isNull(), F.lit("null")).otherwise(_json_string(c))
    body = F.coalesce(canonical(F.coalesce(arguments, F.lit("{}"))), text(arguments))
    return F.concat(
        F.lit('{"arguments":'), body, F.lit(',"id":'), text(call_id), F.lit(',"name":'), text(name),
        F.lit(',"result":'), text(result), F.lit("}"),
    )


def _json_string(value: Column) -> Column:
    """A JSON string: Spark writes an object of one field, of which the frame is cut off."""
    whole = F.to_json(F.struct(value.cast("string").alias("v")))
    return F.substring(whole, 6, F.length(whole) - 6)


def _apart(calls: DataFrame, places: DataFrame, schemas: DataFrame) -> DataFrame:
    """Calls that link with nothing, with ``status``: place behind what they depend on, and errors.

    No call can depend on them, so that one join finds their places.
    """
    rows = materialize(calls.withColumn("__row", F.monotonically_increasing_id()), "apart")
    edges = rows.select("__row", "conv_id", F.explode(F.array_distinct("depends_on")).alias("call_id"))
    after = F.struct(F.col("order_turn").alias("turn"), (F.col("order_step") + 1).alias("step"))
    least = edges.join(places.where("NOT in_cycle"), _KEY).groupBy("__row").agg(F.max(after).alias("least"))
    alone = rows.select(F.col("__row").alias("conv_id"), F.lit("").alias("call_id"), F.lit(0).alias("turn"), "name", "arguments")
    errors = validate(alone, schemas).select(F.col("conv_id").alias("__row"), "errors")
    own = F.struct(F.col("turn").cast("bigint").alias("turn"), F.lit(0).cast("bigint").alias("step"))
    at = F.when(F.col("turn").isNotNull(), F.greatest(own, F.coalesce("least", own)))
    return rows.join(least, "__row", "left").join(errors, "__row", "left").select(
        *_KEY, *_COLUMNS, "status", at["turn"].alias("order_turn"), at["step"].alias("order_step"),
        F.when(F.col("turn").isNotNull(), F.lit(False)).alias("in_cycle"), "errors",
    )


def _results_apart(results: DataFrame, status: str) -> DataFrame:
    return results.select(*_KEY, "result_turn", "result", F.lit(status).alias("status"))


def _with_json(rows: DataFrame) -> DataFrame:
    return rows.withColumn("json", serialise(F.col("name"), F.col("call_id"), F.col("arguments"), F.col("result")))


def format_all(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """All calls and orphan results, also those with a null id: place, status, errors and canonical
    JSON.

    ``calls`` has ``conv_id, call_id, turn, name, arguments, depends_on``; ``results`` has ``conv_id,
    call_id, result_turn, result``.
    """
    calls = calls.select(*_KEY, *_COLUMNS)
    results = results.select(*_KEY, "result_turn", "result")
    linked = materialize(link(calls, results), "linked")
    places = order(linked)
    found = linked.join(places, _KEY, "left").join(validate(linked, schemas), _KEY, "left")
    nameless = calls.where(f"NOT ({_NAMED})").withColumn("status", F.lit("no id"))
    apart = conflicts(calls).withColumn("status", F.lit("conflict")).unionByName(nameless)
    lost = _results_apart(results.where(f"NOT ({_NAMED})"), "no id")
    found = found.unionByName(_apart(apart, places, schemas), allowMissingColumns=True)
    return _with_json(found.unionByName(lost, allowMissingColumns=True))


def format_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """``format_all`` without the calls and results that have a null id."""
    return format_all(calls, results, schemas).where(_NAMED)


def format_turns(turns: DataFrame, schemas: DataFrame) -> DataFrame:
    """``format_all`` of the calls and results of turns, and the turns with a null role."""
    formatted = format_all(*calls_of_turns(turns), schemas)
    turn = F.col("turn").cast("bigint")
    silent = turns.where("role IS NULL").select(
        "conv_id", _turn_name(turn).alias("call_id"), turn.alias("result_turn"), F.col("text").alias("result")
    )
    silent = _results_apart(silent, "no role").withColumns(
        {c: F.lit(None).cast(formatted.schema[c].dataType) for c in ("name", "arguments")}
    )
    return formatted.unionByName(_with_json(silent), allowMissingColumns=True)


def _turn_name(turn: Column) -> Column:
    """The id of a call: null if the conversation or the turn is."""
    return F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))


def calls_of_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that stand for the turns of a conversation table.

    A turn of the user or the system is a call of the tool ``answer`` or ``instruct`` and depends on
    the turn before it; a turn of the assistant is the result of the call one turn earlier.
    """
    turn = F.col("turn").cast("bigint")
    name_of = _turn_name
    conv = F.col("conv_id")
    asked = turns.where("role IN ('user', 'system')")
    arguments = F.to_json(F.struct(F.col("text").alias("text"), turn.alias("after"), F.col("role").alias("from")))
    calls = asked.select(
        conv,
        name_of(turn).alias("call_id"),
        turn.alias("turn"),
        F.when(F.col("role") == "user", "answer").otherwise("instruct").alias("name"),
        arguments.alias("arguments"),
        F.array(name_of(turn - 1), name_of(turn - 2)).alias("depends_on"),
    )
    results = turns.where("role NOT IN ('user', 'system')").select(
        conv, name_of(turn - 1).alias("call_id"), turn.alias("result_turn"), F.col("text").alias("result")
    )
    return calls, results


def turn_schemas(spark) -> DataFrame:
    """Schemas of the two tools of ``calls_of_turns``."""
    rows = [
        (tool, name, kind, needed)
        for tool in ("answer", "instruct")
        for name, kind, needed in (("text", "string", True), ("after", "integer", True), ("from", "string", False))
    ]
    values = ", ".join(f"('{t}', '{n}', '{k}', {str(r).lower()})" for t, n, k, r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(name, property, type, required)")
