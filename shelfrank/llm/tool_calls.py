"""Tool calls linked to their results, ordered, validated and written as JSON.

Calls and results meet by a hash join on (conversation, call id). An argument
whose type is "reference" names another call of the conversation; calls are put
into topological levels along these references (a call's level is one more than
the highest it refers to). Arguments are parsed as variants and validated against
the tools' schemas row by row; a variant keeps its keys sorted, so writing it
gives canonical JSON. Everything is DataFrame code.

Levels are found by doubling: chains of references are jumped along, twice as far
in each step, so a chain of 1000 calls takes 10 steps; lineage is cut in each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tool -> parameter -> (type, required). Types are string, integer, number,
#: boolean, array, object and reference (a call id).
Schemas = dict[str, dict[str, tuple[str, bool]]]

_KINDS = {
    "string": "^STRING$",
    "reference": "^STRING$",
    "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$",
    "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY.*$",
    "object": "^OBJECT.*$",
}
_KEY = ["conv_id", "call_id"]


def _at(parameter: str) -> str:
    quoted = parameter.replace("\\", "\\\\").replace("'", "\\'")
    return f"$['{quoted}']"


def problems(name: Column, args: Column, schemas: Schemas) -> Column:
    """Sorted array of what is wrong with a call's arguments (a variant)."""
    case = F.when(args.isNull(), F.array(F.lit("arguments are not JSON")))
    case = case.when(~F.schema_of_variant(args).startswith("OBJECT"), F.array(F.lit("arguments are not an object")))
    for tool, parameters in sorted(schemas.items()):
        found = []
        for parameter, (kind, required) in sorted(parameters.items()):
            value = F.variant_get(args, _at(parameter), "variant")
            type_ = F.schema_of_variant(value)
            if required:
                found.append(F.when(value.isNull(), F.lit(f"{parameter} is missing")))
            found.append(F.when(value.isNotNull() & ~type_.rlike(_KINDS[kind]), F.lit(f"{parameter} is not {kind}")))
        known = F.array(*map(F.lit, parameters)) if parameters else F.array().cast("array<string>")
        more = F.array_except(F.json_object_keys(F.to_json(args)), known)
        more = F.transform(more, lambda k: F.concat(k, F.lit(" is unknown")))
        wrong = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
        case = case.when(name == tool, F.array_sort(F.concat(wrong, more)))
    return case.otherwise(F.array(F.lit("tool is unknown")))


def references(name: Column, args: Column, schemas: Schemas) -> Column:
    """Call ids that a call's arguments refer to."""
    case = None
    for tool, parameters in sorted(schemas.items()):
        found = [
            F.try_variant_get(args, _at(p), "string") for p, (kind, _) in sorted(parameters.items()) if kind == "reference"
        ]
        if found:
            value = F.array_distinct(F.array_compact(F.array(*found)))
            case = F.when(name == tool, value) if case is None else case.when(name == tool, value)
    empty = F.array().cast("array<string>")
    return empty if case is None else F.coalesce(case, empty)


def _direct(edges: DataFrame) -> DataFrame:
    """Edges less those that a path of two edges through a later id has as well: it
    is longer, so they decide no level. A call that refers to the last k calls keeps
    the last. Ids are ordered by length, then bytes, so what is left still leads to
    every cycle that held the call up."""
    later = lambda c: F.struct(F.length(c), F.col(c))
    first = edges.select("conv_id", "call_id", F.col("needs").alias("via"))
    second = edges.select("conv_id", F.col("call_id").alias("via"), "needs")
    around = first.join(second, ["conv_id", "via"]).where(later("via") > later("needs"))
    return edges.join(around.select(*_KEY, "needs").distinct(), [*_KEY, "needs"], "left_anti")


def _jumped(links: DataFrame) -> DataFrame:
    """links (conv_id, call_id, needs, least, more): a call's level is the larger
    of `least` and the level of `needs` + `more`. Two such steps are one, so the
    links double until `needs` is outside them: log2(longest chain) rounds. Links
    in or behind a cycle never leave and are dropped."""
    rounds = max(1, links.count()).bit_length()
    for _ in range(rounds):
        on = links.select("conv_id", F.col("call_id").alias("needs"), F.col("needs").alias("_n"), F.col("least").alias("_l"), F.col("more").alias("_m"))
        both = links.join(on, ["conv_id", "needs"], "left")
        links = both.select(
            *_KEY,
            F.coalesce("_n", "needs").alias("needs"),
            F.greatest("least", F.col("_l") + F.col("more")).alias("least"),
            (F.col("more") + F.coalesce("_m", F.lit(0))).alias("more"),
            F.col("_n").isNotNull().alias("moved"),
        ).checkpoint()
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    return links.join(links.select("conv_id", F.col("call_id").alias("needs")), ["conv_id", "needs"], "left_anti")


def levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the calls that no cycle holds up. edges:
    (conv_id, call_id, needs), both calls known.

    A round takes the calls with at most one reference to a call without level as
    links and jumps along them; calls with more wait for the next round. So chains,
    and calls that refer to the last few, take log2(length) steps in all. What can
    still take a round a call is a chain of calls with two references each that do
    not follow from each other in two steps."""
    edges = _direct(edges).checkpoint()
    solved = [calls.select(*_KEY).join(edges, _KEY, "left_anti").withColumn("level", F.lit(0)).checkpoint()]
    while not solved[-1].isEmpty():
        done = reduce(DataFrame.unionByName, solved)
        met = done.select("conv_id", F.col("call_id").alias("needs"), "level")
        rest = edges.join(done, _KEY, "left_anti").join(met, ["conv_id", "needs"], "left")
        rest = rest.groupBy(*_KEY).agg(
            F.coalesce(F.max("level") + 1, F.lit(0)).alias("least"),
            F.count_if(F.col("level").isNull()).alias("open"),
            F.max(F.when(F.col("level").isNull(), F.col("needs"))).alias("needs"),
        ).checkpoint()
        ready = rest.where("open = 0").select(*_KEY, F.col("least").alias("level"))
        links = _jumped(rest.where("open = 1").select(*_KEY, "needs", "least", F.lit(1).alias("more")))
        at = ready.select("conv_id", F.col("call_id").alias("needs"), "level")
        behind = links.join(at, ["conv_id", "needs"]).select(*_KEY, F.greatest("least", F.col("level") + F.col("more")).alias("level"))
        solved.append(ready.unionByName(behind).checkpoint())
    return reduce(DataFrame.unionByName, solved)


def _unknown(needs: DataFrame, targets: DataFrame, key: list[str]) -> DataFrame:
    """(key, unknown): what needs (key, conv_id, needs) names and targets lack."""
    missing = needs.join(targets, ["conv_id", "needs"], "left_anti")
    return missing.groupBy(*key).agg(F.array_sort(F.collect_set(F.concat(F.lit("no call "), "needs"))).alias("unknown"))


def _further(rows: DataFrame, one: DataFrame, chosen: str, count: str) -> DataFrame:
    """The rows besides the chosen one of each id, with a count of 1."""
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"{chosen}.{c}")) for c in rows.columns if c not in _KEY))
    several = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    several = several.join(one.where(F.col(count) > 1).select(*_KEY, chosen), _KEY)
    left = several.withColumn("n", F.col("n") - F.when(same, 1).otherwise(0)).where("n > 0")
    left = left.withColumn(count, F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return left.select(*rows.columns, F.lit(1).cast("long").alias(count))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per (conv_id, call_id) of calls or results, one per further call
    or result with the same id, and one per call or result without an id.

    calls: (conv_id, turn, call_id, name, arguments as JSON text); results:
    (conv_id, turn, call_id, content). Other columns are ignored. Columns out:
    conv_id, call_id, turn, name, status (`linked`, `no_result`, `no_call`,
    `no_id`, `duplicate`), level (null for results without call, for calls in or
    behind a cycle, and for duplicates), valid, problems (array), n_calls and
    n_results (rows with this id), and record: canonical JSON of the call and its result. Order by
    (level, turn, call_id) within a conversation. Null contents and empty texts
    stay as they are; empty tables give no rows.

    Of several calls or results with one id the one of the least turn, then in
    order of its other columns, is linked. Each other one is a row of its own of
    status `duplicate`, which counts itself alone; references to its id mean the
    linked call."""
    empty_args = F.try_parse_json(F.lit(None).cast("string"))
    no_id = F.col("conv_id").isNull() | F.col("call_id").isNull()
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments")
    results = results.select("conv_id", "turn", "call_id", "content")
    one_call = calls.where(~no_id).groupBy(*_KEY).agg(
        F.min(F.struct("turn", "name", "arguments")).alias("call"), F.count("*").alias("n_calls")
    )
    one_result = results.where(~no_id).groupBy(*_KEY).agg(
        F.min(F.struct(F.col("turn").alias("result_turn"), "content")).alias("result"), F.count("*").alias("n_results")
    )
    known = one_call.select(*_KEY, "call.*", "n_calls")
    rows = known.join(one_result.select(*_KEY, "result.*", "n_results"), _KEY, "full")
    loose_calls = calls.where(no_id).withColumn("n_calls", F.lit(1).cast("long"))
    loose_results = results.where(no_id).select(
        *_KEY, F.col("turn").alias("result_turn"), "content", F.lit(1).cast("long").alias("n_results")
    )
    rows = rows.unionByName(loose_calls, allowMissingColumns=True).unionByName(loose_results, allowMissingColumns=True)

    args = F.try_parse_json("arguments")
    needs = known.select(*_KEY, F.explode(references(F.col("name"), args, schemas)).alias("needs")).checkpoint()
    targets = known.select("conv_id", F.col("call_id").alias("needs"))
    level = levels(known, needs.join(targets, ["conv_id", "needs"], "left_semi"))
    rows = rows.join(level, _KEY, "left").join(_unknown(needs, targets, _KEY), _KEY, "left")

    more_calls = _further(calls.where(~no_id), one_call, "call", "n_calls").checkpoint()
    more_calls = more_calls.withColumn("row", F.monotonically_increasing_id())
    needs = more_calls.select("row", "conv_id", F.explode(references(F.col("name"), args, schemas)).alias("needs"))
    more_calls = more_calls.join(_unknown(needs, targets, ["row"]), "row", "left").drop("row")
    more_results = results.where(~no_id).withColumnRenamed("turn", "result_turn")
    more = more_calls.unionByName(_further(more_results, one_result, "result", "n_results"), allowMissingColumns=True)
    rows = more.withColumn("further", F.lit(True)).unionByName(rows, allowMissingColumns=True)

    is_call = F.col("n_calls").isNotNull()
    status = (
        F.when(no_id, "no_id")
        .when(F.col("further"), "duplicate")
        .when(F.col("n_calls").isNull(), "no_call")
        .when(F.col("n_results").isNull(), "no_result")
        .otherwise("linked")
    )
    cycle = F.when(~no_id & F.col("further").isNull() & F.col("level").isNull(), F.array(F.lit("refers to itself")))
    none = F.array().cast("array<string>")
    wrong = F.when(
        is_call,
        F.concat(problems(F.col("name"), args, schemas), F.coalesce("unknown", none), F.coalesce(cycle, none)),
    ).otherwise(none)
    rows = rows.withColumn("status", status).withColumn("problems", wrong)
    parsed = F.when(is_call & args.isNotNull(), args).otherwise(empty_args)
    raw = F.when(is_call & args.isNull(), F.col("arguments"))
    # Keys in order, null ones left out, as in the arguments themselves.
    record = F.to_json(
        F.struct(
            parsed.alias("arguments"),
            "call_id",
            "conv_id",
            "level",
            "name",
            raw.alias("raw_arguments"),
            F.col("content").alias("result"),
            "status",
        )
    )
    return rows.select(
        "conv_id",
        "call_id",
        F.coalesce("turn", "result_turn").alias("turn"),
        "name",
        "status",
        "level",
        (is_call & (F.size("problems") == 0)).alias("valid"),
        "problems",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        record.alias("record"),
    )


# ------------------------------------------------------------ stand-in input

TOOLS: Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", False), "after": ("reference", False)},
    "open": {"page": ("integer", True), "after": ("reference", True)},
    "note": {"text": ("string", True)},
}


def conversation_calls(conversations: DataFrame) -> DataFrame:
    """Calls in the schema that `link` takes: each assistant turn as one call
    whose arguments hold its words, lengths and the turn two before."""
    tool = F.element_at(F.array(*map(F.lit, sorted(TOOLS))), (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3)) + 1).cast("int"))
    after = F.when(F.col("turn") >= 3, F.concat(F.lit("c"), (F.col("turn") - 2).cast("string")))
    size = F.length("text")
    arguments = (
        F.when(F.col("name") == "search", F.to_json(F.struct(F.col("text").alias("query"), size.alias("limit"), after.alias("after"))))
        .when(F.col("name") == "open", F.to_json(F.struct(after.alias("after"), size.alias("page"))))
        .otherwise(F.to_json(F.struct("text")))
    )
    return conversations.where(F.col("role") == "assistant").withColumn("name", tool).select(
        "conv_id", "turn", F.concat(F.lit("c"), F.col("turn").cast("string")).alias("call_id"), "name", arguments.alias("arguments")
    )


def conversation_results(conversations: DataFrame) -> DataFrame:
    """Results in the schema that `link` takes: each user turn answers the turn
    before it."""
    call_id = F.concat(F.lit("c"), (F.col("turn") - 1).cast("string"))
    return conversations.where(F.col("role") == "user").select(
        "conv_id", "turn", call_id.alias("call_id"), F.col("text").alias("content")
    )
