"""Tool-call linking for chat data (operator 5, native).

Calls and results are hash-joined by identifier; a call may name the call
whose result it follows, and pointer doubling gives every call its depth in
that order (a call's depth is above that of the call it follows); arguments
are validated against the tools' schemas; each call is serialised as one line
of canonical JSON (sorted keys, no spaces, no null fields).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.tables import stored

#: JSON types of a schema and the variant types that satisfy them.
TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$",
         "boolean": "^BOOLEAN$", "object": "^OBJECT<", "array": "^ARRAY<"}


def depths(calls: DataFrame) -> DataFrame:
    """``(call_id, depth)`` of every distinct id; ``depth`` is null in or behind a cycle.

    Pointer doubling: a round doubles the reach of every pointer, so a chain of
    n calls takes about log2(n) rounds of one join.  Where an id repeats, the
    smallest parent counts; a parent that is no call is none."""
    own = calls.filter("call_id is not null").groupBy("call_id").agg(F.min("parent_id").alias("parent"))
    known = own.select(F.col("call_id").alias("parent"))
    # calls without a parent, and chains that have ended, take no part in the joins: they
    # have no key, and would all meet in one task
    roots = own.filter("parent is null").select("call_id", F.col("parent").alias("up"), F.lit(0).cast("long").alias("depth"))
    led = own.filter("parent is not null").join(known.withColumn("hit", F.lit(True)), "parent", "left").select(
        "call_id", F.when(F.col("hit"), F.col("parent")).alias("up"),
        F.when(F.col("hit"), 1).otherwise(0).cast("long").alias("depth"))
    cur = stored(led.unionByName(roots), "depth")
    n = cur.count()
    reach = 1
    while reach <= n and cur.filter("up is not null").take(1):
        far = cur.select(F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        on = cur.filter("up is not null").join(far, "up", "left").select(
            "call_id", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        cur = stored(on.unionByName(cur.filter("up is null")), "depth")
        reach *= 2
    return cur.select("call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def argument_error(name: Column, arguments: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """The first fault of a call's arguments, null if none: ``unknown_tool``, ``not_an_object``
    (no JSON, a repeated key, no object), ``missing:<p>``, ``type:<p>``, then ``unexpected:<p>``."""
    v = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    repeated = F.size(keys) != F.size(F.array_distinct(keys))      # whatever the session lets parse
    faults = F.when(name.isNull() | ~name.isin(*schemas), F.lit("unknown_tool")).when(
        F.coalesce(repeated | ~F.schema_of_variant(v).startswith("OBJECT"), F.lit(True)), F.lit("not_an_object"))
    for tool, params in schemas.items():
        at = name == tool
        for p, (kind, required) in sorted(params.items()):
            got = F.schema_of_variant(F.try_variant_get(v, f"$.{p}", "variant"))
            absent = got.isNull() | (got == "VOID")
            if required:
                faults = faults.when(at & absent, F.lit(f"missing:{p}"))
            faults = faults.when(at & ~absent & ~got.rlike(TYPES[kind]), F.lit(f"type:{p}"))
        extra = F.array_sort(F.array_except(keys, F.array(*[F.lit(p) for p in params])))
        faults = faults.when(at & (F.size(extra) > 0), F.concat(F.lit("unexpected:"), F.get(extra, F.lit(0))))
    return faults


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """``conv_id, turn, call_id, depth, status, error, n_results, line`` of every call and orphan result.

    ``calls``: ``conv_id, turn, call_id, parent_id, name, arguments``; ``results``:
    ``conv_id, turn, call_id, content`` (other columns are ignored).  A call has
    the result of its id with the smallest (turn, content); ``n_results`` counts
    all.  ``status`` is ``cycle``, ``invalid`` (see ``argument_error``),
    ``no_result``, ``ok``, or ``orphan`` for results whose id is null or no
    call's.  A call without an id links with nothing and has depth 0.  Calls
    that repeat an id share its results and its depth.  (depth, turn, call_id) is a
    topological order of each conversation.  Empty tables give no rows.
    """
    first = results.filter("call_id is not null").groupBy("call_id").agg(
        F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
    at = calls.select("conv_id", "turn", "call_id", "parent_id", "name", "arguments")
    linked = at.filter("call_id is not null").join(first.hint("shuffle_hash"), "call_id", "left").join(depths(at), "call_id", "left")
    linked = linked.unionByName(at.filter("call_id is null"), allowMissingColumns=True)
    depth = F.when(F.col("call_id").isNull(), F.lit(0).cast("long")).otherwise(F.col("depth"))
    error = argument_error(F.col("name"), F.col("arguments"), schemas)
    out = linked.withColumn("depth", depth).withColumn("error", error)
    status = F.when(F.col("depth").isNull(), "cycle").when(F.col("error").isNotNull(), "invalid") \
        .when(F.col("r").isNull(), "no_result").otherwise("ok")
    whole = F.coalesce(F.size(F.json_object_keys("arguments")) == F.size(F.array_distinct(F.json_object_keys("arguments"))), F.lit(False))
    args = F.when(whole, F.try_parse_json("arguments"))
    line = F.to_json(F.struct(args.alias("arguments"), "call_id", F.col("r.content").alias("content"), "depth",
                              "name", "parent_id"))
    done = out.select("conv_id", "turn", "call_id", "depth", status.alias("status"), "error",
                      F.coalesce("n_results", F.lit(0)).alias("n_results"), line.alias("line"))
    ids = at.filter("call_id is not null").select("call_id").distinct()
    told = results.select("conv_id", "turn", "call_id", "content")
    orphan = told.filter("call_id is not null").join(ids, "call_id", "left_anti").unionByName(told.filter("call_id is null"))
    return done.unionByName(orphan.select(
        "conv_id", "turn", "call_id", F.lit(None).cast("long").alias("depth"), F.lit("orphan").alias("status"),
        F.lit(None).cast("string").alias("error"), F.lit(1).cast("long").alias("n_results"),
        F.to_json(F.struct("call_id", "content")).alias("line")))
