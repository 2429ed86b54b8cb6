"""Linking tool calls of conversations with their results.

Calls and results meet in one hash join by conversation, identifier and the number of
the call or result among those of its identifier, by turn: the second result of an
identifier belongs to its second call. Every call and every result is in the output
once. Arguments are parsed, checked against the schema of their tool and written as
canonical JSON: keys in order, no spaces.

Calls can name calls they build on; a name stands for the first call of that identifier.
A call stands where its turn puts it, unless it
builds on a later one; then it moves behind that one, and calls that build on it move
along. Places are raised in rounds until all agree, so the number of rounds is the
length of the longest run of moved calls, none where calls build on earlier ones only.
A call that moved more often than there are moved calls in its conversation builds on
itself: it is marked cyclic, and the calls it builds on no longer move it.

Identifiers are strings; what has none links with nothing: its call is pending, its
result an orphan. Rows without a conversation have one each for themselves. Missing arguments are an empty object. Rows of other
roles are ignored, as are columns other than the named ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.operators.numbering import numbered
from starsift.operators.skew import lookup_join
from starsift.sources.workspace import discard, materialize

# JSON types by the beginning of the type a parsed value has.
TYPES = {
    "string": "^STRING", "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))", "boolean": "^BOOLEAN",
    "number": "^(BIGINT|DECIMAL|DOUBLE)", "array": "^ARRAY", "object": "^OBJECT", "null": "^VOID",
}


def canonical(json: Column) -> Column:
    """JSON with sorted keys and without spaces; null for what is no JSON."""
    return F.to_json(F.try_parse_json(json))


def argument_problems(
    name: Column, arguments: Column, schemas: Mapping[str, Mapping[str, dict]]
) -> Column:
    """What is wrong with arguments, as an array of texts in order.

    ``schemas`` has, by tool, its fields: ``type`` (one of :data:`TYPES`), ``required``
    and ``enum`` of strings. Fields that a schema does not have are a problem too.
    """
    parsed = F.try_parse_json(arguments)
    unknown = F.array(F.lit("unknown tool"))
    found = unknown
    for tool, fields in schemas.items():
        checks = []
        for field, rule in sorted(fields.items()):
            path = f"$['{field}']" if "'" not in field else f'$["{field}"]'
            value = F.try_variant_get(parsed, path, "variant")
            kind = F.schema_of_variant(value)
            if rule.get("required"):
                checks.append(F.when(value.isNull(), F.lit(f"{field}: missing")))
            if rule.get("type"):
                checks.append(
                    F.when(value.isNotNull() & ~kind.rlike(TYPES[rule["type"]]),
                           F.lit(f"{field}: not {rule['type']}"))
                )
            if rule.get("enum"):
                text = F.try_variant_get(parsed, path, "string")
                checks.append(F.when(value.isNotNull() & ~F.coalesce(
                    text.isin(list(rule["enum"])), F.lit(False)), F.lit(f"{field}: not allowed")))
        known = F.array(*[F.lit(f) for f in sorted(fields)]).cast("array<string>")
        extra = F.transform(
            F.array_sort(F.array_except(F.json_object_keys(F.to_json(parsed)), known)),
            lambda k: F.concat(k, F.lit(": unknown")),
        )
        own = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
        found = F.when(name == tool, F.concat(own, extra)).otherwise(found)
    shape = F.schema_of_variant(parsed)
    return (
        F.when(parsed.isNull(), F.array(F.lit("not JSON")))
        .when(~shape.rlike("^OBJECT"), F.array(F.lit("not an object")))
        .otherwise(found)
    )


def _ordered(calls: DataFrame, after: DataFrame) -> DataFrame:
    """(conv, id, place, hops, cyclic) of calls (conv, id, place), moved behind others.

    ``after`` has (conv, id, other): what builds on what. Order is by place, then hops.
    """
    state = materialize(
        calls.select("conv", "id", "place", F.col("place").alias("own"),
                     F.lit(0).alias("hops"), F.lit(False).alias("cyclic")),
        "places",
    )
    edges = materialize(after.filter("id <> other").distinct(), "after")
    looped = after.filter("id = other").select("conv", "id").distinct()
    while not edges.isEmpty():
        held = state.select(
            "conv", F.col("id").alias("other"),
            F.struct("place", (F.col("hops") + 1).alias("hops")).alias("behind"),
        )
        raised = edges.join(held, ["conv", "other"]).groupBy("conv", "id").agg(
            F.max("behind").alias("behind")
        )
        moved = F.col("behind") > F.struct("place", "hops")
        new = state.join(raised, ["conv", "id"], "left").withColumn(
            "moved", F.coalesce(moved & ~F.col("cyclic"), F.lit(False))
        )
        new = materialize(
            new.select(
                "conv", "id", "own",
                F.when(F.col("moved"), F.col("behind.place")).otherwise(F.col("place")).alias("place"),
                F.when(F.col("moved"), F.col("behind.hops")).otherwise(F.col("hops")).alias("hops"),
                "cyclic", "moved",
            ),
            "places",
        )
        if new.filter("moved").isEmpty():
            discard(new)
            break
        sizes = new.filter("hops > 0").groupBy("conv").agg(F.count("*").alias("many"))
        turned = F.col("hops") > F.coalesce("many", F.lit(0))
        next_ = materialize(
            new.join(sizes, "conv", "left").select(
                "conv", "id", "own",
                F.when(turned, F.col("own")).otherwise(F.col("place")).alias("place"),
                F.when(turned, F.lit(0)).otherwise(F.col("hops")).alias("hops"),
                (F.col("cyclic") | turned).alias("cyclic"),
            ),
            "places",
        )
        for table in (state, new):
            discard(table)
        state = next_
    return state.join(looped.withColumn("self", F.lit(True)), ["conv", "id"], "left").select(
        "conv", "id", "place", "hops", "own",
        (F.col("cyclic") | F.coalesce("self", F.lit(False))).alias("cyclic"),
    )


def _told_apart(rows: DataFrame, mark: str, order: list) -> DataFrame:
    """Rows with ``conv``, a number ``row`` and ``again``, their place among equal identifiers.

    Numbers come from a range sort, so an identifier of many rows is in many tasks.
    """
    own = materialize(rows.withColumn("_at", F.monotonically_increasing_id()), "rows")
    conv = F.coalesce(
        F.concat(F.lit("0"), F.col("conv_id").cast("string")),
        F.concat(F.lit(mark), F.col("_at").cast("string")),
    )
    lined = materialize(
        numbered(own.withColumn("conv", conv), ["conv", "call_id", *order], "row"), "numbered"
    ).withColumn("pair", F.struct("conv", "call_id"))
    starts = materialize(
        lined.groupBy("pair").agg(F.min("row").alias("start"), F.count("*").alias("size")),
        "starts",
    )
    return lookup_join(lined, starts, "pair", "size").withColumn(
        "again", F.col("row") - F.col("start")
    ).drop("pair", "start", "size", "_at")


def link_tool_calls(
    calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, dict]]
) -> DataFrame:
    """One row for each call, and for each result without one.

    ``calls`` has (conv_id, turn, call_id, name, arguments, after), ``after`` an array
    of identifiers; ``results`` has (conv_id, turn, call_id, content). Out come
    (conv_id, position, call_id, again, name, status, problems, cyclic, json): ``again``
    counts the calls (or results) of the identifier before this one; ``status`` is linked,
    pending (no result), early (the result stands before its call) or orphan (no call);
    positions count the calls of a conversation from 1, in topological order, and are 0
    for orphans; ``json`` is the canonical record.
    """
    asked = _told_apart(
        calls.select("conv_id", "turn", "call_id", "name", "arguments", "after"), "1",
        ["turn", "name", "arguments", F.to_json(F.struct("after")), "_at"],
    )
    got = _told_apart(
        results.select("conv_id", "turn", "call_id", "content"), "2", ["turn", "content", "_at"]
    )
    first = asked.filter(F.col("call_id").isNotNull() & (F.col("again") == 0)).select(
        "conv", F.col("call_id").alias("named"), F.col("row").alias("other")
    )
    after = asked.select(
        "conv", F.col("row").alias("id"), F.explode("after").alias("named")
    ).join(first, ["conv", "named"]).select("conv", "id", "other")
    placed = _ordered(asked.select("conv", F.col("row").alias("id"), F.struct(
        "turn", F.col("call_id").alias("tie"), "again").alias("place")), after)
    lined = numbered(placed, ["conv", "place", "hops", "own", "id"], "number")
    starts = materialize(
        lined.groupBy("conv").agg(F.min("number").alias("start"), F.count("*").alias("size")),
        "starts",
    )
    lined = lookup_join(lined, starts, "conv", "size").select(
        F.col("id").alias("row"), "cyclic", (F.col("number") - F.col("start") + 1).alias("position")
    )
    keys = ["conv", "call_id", "again"]
    met = asked.select(
        *keys, "row", "conv_id", F.struct("turn", "name", "arguments").alias("call")
    ).join(
        got.select(*keys, F.struct("turn", "content").alias("result"),
                   F.col("conv_id").alias("result_conv")),
        keys, "full",
    ).join(lined, "row", "left")
    arguments = F.coalesce("call.arguments", F.lit("{}"))
    status = (
        F.when(F.col("call").isNull(), "orphan").when(F.col("result").isNull(), "pending")
        .when(F.col("result.turn") < F.col("call.turn"), "early").otherwise("linked")
    )
    rest = F.to_json(
        F.struct(F.col("call_id").alias("id"), F.col("call.name").alias("name"),
                 F.col("result.content").alias("result")), {"ignoreNullFields": "false"}
    )
    problems = F.when(F.col("call").isNotNull(), F.array_join(
        argument_problems(F.coalesce("call.name", F.lit("")), arguments, schemas), "; "))
    shown = F.when(F.col("call").isNotNull(), F.coalesce(canonical(arguments), F.lit("null")))
    return met.select(
        F.coalesce("conv_id", "result_conv").alias("conv_id"),
        F.coalesce("position", F.lit(0)).alias("position"), "call_id",
        F.when(F.col("call_id").isNull(), F.lit(0)).otherwise(F.col("again")).alias("again"),
        F.col("call.name").alias("name"), status.alias("status"),
        problems.alias("problems"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        F.concat(F.lit('{"arguments":'), F.coalesce(shown, F.lit("null")), F.lit(","),
                 F.substring(rest, 2, 2147483647)).alias("json"),
    )
