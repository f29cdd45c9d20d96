"""Tool calls linked with their results, ordered, validated and written as canonical JSON.

Everything is DataFrame operations: a hash join by (conv_id, call_id), rounds of joins for
the topological order, column expressions for the schemas, and Spark's variant type, which
keeps the keys of an object in order, for canonical JSON. Keys are call ids, not conversations, so
a conversation with very many turns is no hot key, and no conversation is gathered.

A call is (conv_id, call_id, turn, name, arguments, depends_on), its arguments JSON text. A
result is (conv_id, call_id, turn, content). Schemas are a dict: tool -> field -> (type,
required), with the types string, integer, number, boolean, array and object.

Result, one row per call and per result without one: `status` is `answered`, `unanswered`,
`repeated` (a later call or result with an id already used; the first by turn, then by content
counts), `orphan` (a result without a call). `step` is 0 for calls that depend on no known
call, else one more than the highest step among those; null on or behind a cycle. `problem`
is empty or the first fault of the arguments. `message` is the canonical JSON.

Edge cases: null ids link with nothing; null arguments are not JSON; dependencies on unknown
calls, and null or repeated ones, are ignored for the order; JSON that repeats a key is not
JSON here. Arguments that are not JSON are kept as a string. Empty inputs give an empty
result; further columns are ignored.
"""

from pyspark.sql import Column, DataFrame, functions as F

from postlake.session import stage

KEY = ["conv_id", "call_id"]
#: Each JSON type with what Spark calls it.
TYPE_PATTERNS = {
    "string": "^STRING$", "integer": "^(BIGINT|DECIMAL\\([0-9]+,0\\))$", "boolean": "^BOOLEAN$",
    "number": "^(BIGINT|DOUBLE|DECIMAL\\(.*)$", "array": "^ARRAY<", "object": "^OBJECT<",
}


def canonical(json_text: Column) -> Column:
    """JSON text with sorted keys and no spaces; null if the text is not JSON."""
    return F.to_json(F.try_parse_json(json_text))


def _field_type(arguments: Column, name: str) -> Column:
    quoted = name.replace("\\", "\\\\").replace('"', '\\"')
    return F.schema_of_variant(F.try_variant_get(arguments, f'$["{quoted}"]', "variant"))


def argument_problem(name: Column, arguments: Column, schemas: dict) -> Column:
    """Empty, or the first fault of a call's arguments under its tool's schema."""
    parsed = F.try_parse_json(arguments)
    by_tool = F.when(F.lit(False), F.lit(""))
    for tool, fields in schemas.items():
        found = F.when(F.lit(False), F.lit(""))
        for field, (kind, required) in fields.items():
            is_type = _field_type(parsed, field)
            if required:
                found = found.when(is_type.isNull(), F.lit(f"missing {field}"))
            found = found.when(is_type.isNotNull() & ~is_type.rlike(TYPE_PATTERNS[kind]), F.lit(f"type of {field}"))
        others = F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(f) for f in fields]).cast("array<string>"))
        found = found.when(F.size(others) > 0, F.concat(F.lit("unexpected "), F.array_min(others)))
        by_tool = by_tool.when(name == tool, found.otherwise(""))
    return (
        F.when(parsed.isNull(), "not JSON")
        .when(~F.schema_of_variant(parsed).startswith("OBJECT<"), "not an object")
        .otherwise(F.coalesce(by_tool, F.lit("unknown tool")))
    )


def _jumps(alone: DataFrame) -> DataFrame:
    """(conv_id, call_id, base, far) of calls (conv_id, call_id, base) that wait for one call each:
    the first call down the chain that does not, and how many links away it is. Calls whose chain
    runs into a cycle are left out.

    Every round doubles the links looked over, so a chain of a thousand calls takes ten.
    """
    jumps, length, longest = stage(alone.withColumn("far", F.lit(1)), "jumps"), 1, alone.count()
    while True:
        # What another of these calls stands for is looked up under its id.
        onward = jumps.select("conv_id", F.col("call_id").alias("base"), F.col("base").alias("next"), F.col("far").alias("more"))
        if jumps.join(onward.select("conv_id", "base"), ["conv_id", "base"], "left_semi").isEmpty():
            return jumps
        if length > longest:
            return jumps.join(onward.select("conv_id", "base"), ["conv_id", "base"], "left_anti").select(*KEY, "base", "far")
        jumps, length = stage(
            jumps.join(onward, ["conv_id", "base"], "left").select(
                *KEY, F.coalesce("next", "base").alias("base"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far")
            ), "jumps",
        ), 2 * length


def topological_steps(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, step) of calls not on or behind a cycle; calls have unique ids.

    Calls that wait for one other form chains, which pointer doubling takes in one go. Those
    that wait for several are ordered in rounds: each takes off the calls whose bases all have a
    step, so there are as many rounds as such calls follow each other on a path. Rounds are
    written to the shared folder.
    """
    ids = calls.select(*KEY)
    wants = calls.select(*KEY, F.explode(F.array_distinct("depends_on")).alias("needs"))
    links = stage(
        wants.join(ids.withColumnRenamed("call_id", "needs"), ["conv_id", "needs"], "left_semi").select(*KEY, "needs"), "links"
    )
    front = stage(ids.join(links.select(*KEY).distinct(), KEY, "left_anti").withColumn("step", F.lit(0)), "front")
    counts = links.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("needs").alias("base"))
    alone = stage(counts.where("n = 1").select(*KEY, "base"), "alone")
    jumps = stage(_jumps(alone), "chains")
    # Links of calls that wait for several, from their bases: `value` is the step they ask for.
    several = links.join(counts.where("n > 1").select(*KEY), KEY, "left_semi")
    chained = jumps.withColumnsRenamed({"call_id": "needs", "base": "far_base"})
    pending = stage(
        several.join(alone.select("conv_id", F.col("call_id").alias("needs"), F.lit(True).alias("single")), ["conv_id", "needs"], "left")
        .join(chained, ["conv_id", "needs"], "left")
        .select(
            *KEY, F.when(F.col("single"), F.col("far_base")).otherwise(F.col("needs")).alias("base"),
            F.coalesce("far", F.lit(0)).alias("far"), F.lit(None).cast("int").alias("value"),
        ), "pending",
    )
    steps = front
    while not pending.isEmpty():
        met = front.withColumnsRenamed({"call_id": "base", "step": "known"})
        left = stage(
            pending.join(met, ["conv_id", "base"], "left").select(
                *KEY, "base", "far", F.coalesce("value", F.col("known") + F.col("far") + 1).alias("value")
            ), "pending",
        )
        front = stage(
            left.groupBy(*KEY).agg(F.count_if(F.col("value").isNull()).alias("open"), F.max("value").alias("step"))
            .where("open = 0").select(*KEY, "step"), "front",
        )
        if front.isEmpty():
            break
        steps, pending = steps.union(front), left.join(front.select(*KEY), KEY, "left_anti")
    ends = steps.select("conv_id", F.col("call_id").alias("base"), "step")
    return steps.union(jumps.join(ends, ["conv_id", "base"]).select(*KEY, (F.col("step") + F.col("far")).alias("step")))


def _firsts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per key with the first row's columns, and the others' in `rest`."""
    everything = F.struct(*columns)
    first = rows.where(F.col("call_id").isNotNull() & F.col("conv_id").isNotNull()).groupBy(*KEY).agg(
        F.min(everything).alias("first"), F.count("*").alias("n")
    )
    return first.select(*KEY, "first.*", "n")


def _later(rows: DataFrame, firsts: DataFrame, columns: list[str]) -> DataFrame:
    """Rows beyond the first of each key, and rows without a key."""
    keyed = rows.where(F.col("call_id").isNotNull() & F.col("conv_id").isNotNull()).groupBy(*KEY, *columns).agg(F.count("*").alias("n"))
    again = firsts.select(*KEY, F.struct(*columns).alias("first"))
    # Equal rows count once as the first; only keys with several rows take part.
    many = keyed.join(again.where("true"), KEY).withColumn(
        "more", F.col("n") - F.when(F.struct(*columns) == F.col("first"), 1).otherwise(0)
    )
    return many.where("more > 0").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("more")))).select(*KEY, *columns)


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """(conv_id, call_id, turn, kind, status, step, problem, message); see the module. Runs
    jobs when called."""
    call_columns, result_columns = ["turn", "name", "arguments", "depends_on"], ["turn", "content"]
    calls = calls.select(*KEY, *call_columns)
    results = results.select(*KEY, *result_columns)
    first_calls = stage(_firsts(calls, call_columns), "calls")
    first_results = stage(_firsts(results, result_columns), "results")
    steps = topological_steps(first_calls.select(*KEY, "depends_on"))
    known = first_calls.select(*KEY, *call_columns).join(steps, KEY, "left")
    answers = first_results.select(*KEY, F.col("turn").alias("result_turn"), "content", F.lit(True).alias("answered"))
    linked = known.withColumn("called", F.lit(True)).join(answers, KEY, "full_outer")
    blank = {"result_turn": F.lit(None).cast("bigint"), "content": F.lit(None).cast("string")}
    columns = [*KEY, *call_columns, "result_turn", "content", "step", "kind", "status"]
    main = linked.withColumns({
        "kind": F.when(F.col("called"), "call").otherwise("result"),
        "status": F.when(F.col("called").isNull(), "orphan").when(F.col("answered"), "answered").otherwise("unanswered"),
    }).select(*columns)
    no_step = F.lit(None).cast("int")
    keyless = F.col("call_id").isNull() | F.col("conv_id").isNull()
    later_calls = _later(calls, first_calls.where("n > 1"), call_columns).withColumn("status", F.lit("repeated")).union(
        calls.where(keyless).withColumn("status", F.lit("unanswered"))
    ).withColumns({**blank, "step": no_step, "kind": F.lit("call")}).select(*columns)
    no_call = {"name": F.lit(None).cast("string"), "arguments": F.lit(None).cast("string"),
               "depends_on": F.lit(None).cast("array<string>"), "step": no_step, "kind": F.lit("result")}
    later_results = _later(results, first_results.where("n > 1"), result_columns).withColumn("status", F.lit("repeated")).union(
        results.where(keyless).withColumn("status", F.lit("orphan"))
    ).withColumnRenamed("turn", "result_turn").withColumns({**no_call, "turn": F.lit(None).cast("bigint")}).select(*columns)
    rows = main.unionByName(later_calls).unionByName(later_results)
    text = lambda c: F.coalesce(F.to_json(F.to_variant_object(F.array(c))).substr(F.lit(2), F.length(F.to_json(F.to_variant_object(F.array(c)))) - 2), F.lit("null"))  # noqa: E731,E501
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    needs = F.to_json(F.to_variant_object(F.coalesce(F.sort_array(F.array_distinct("depends_on")), F.array().cast("array<string>"))))
    part = lambda key, value: [F.lit(f'"{key}":'), value, F.lit(",")]
    call_message = F.concat(
        F.lit("{"), *part("arguments", F.coalesce(canonical(F.col("arguments")), text(F.col("arguments")))),
        *part("conv_id", number("conv_id")), *part("depends_on", needs), *part("id", text(F.col("call_id"))),
        *part("name", text(F.col("name"))), *part("result", text(F.col("content"))),
        F.lit('"turn":'), number("turn"), F.lit("}"),
    )
    result_message = F.concat(
        F.lit("{"), *part("conv_id", number("conv_id")), *part("id", text(F.col("call_id"))),
        *part("result", text(F.col("content"))), F.lit('"turn":'), number("result_turn"), F.lit("}"),
    )
    is_call = F.col("kind") == "call"
    return rows.select(
        *KEY, F.coalesce("turn", "result_turn").alias("turn"), "kind", "status", "step",
        F.when(is_call, argument_problem(F.col("name"), F.col("arguments"), schemas)).otherwise("").alias("problem"),
        F.when(is_call, call_message).otherwise(result_message).alias("message"),
    )
