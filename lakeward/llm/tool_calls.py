"""Tool-call linking on DataFrame functions alone.

Calls and results meet by hash join on (conversation, call id).  Calls may name a parent, the call whose result they
use; their topological depth comes from pointer jumping over the parent table (a round
doubles the distance covered, so a chain of any length takes its logarithm in joins).  Ordering a conversation's
calls by (depth, turn, call_id) puts every parent before its children; calls on a cycle have no depth.  Arguments are
checked against the schema table by a join on (tool, argument), and every link is
written as canonical JSON: keys sorted at every level, no white space, nulls left out at the top level.

No conversation is gathered into one row, so one of any length is spread over tasks.

No row is lost and none loses its text: whatever the canonical JSON cannot hold (arguments that are no JSON or repeat a key,
integers beyond 38 digits, which the engine's JSON reads as doubles, and the number's own spelling) stands in ``arguments`` as it was given.

Defined cases: results without a call and calls without a result are returned with their status; of
calls that share an id in a conversation the first by (turn, name, arguments, parent) is linked, the others are
"duplicate", each with its own turn, name and arguments; of several results of a call the first by (turn, content) is linked and all
are counted, the others are "extra_result" with their own turn and content, as are those of a result without a call; a parent that does not exist
counts as none; null ids never match; arguments that are no JSON object are invalid; a tool
without schema accepts any object; null texts stay null; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.textkit import stored

# JSON kinds a schema type accepts, as the engine names them
KINDS = {"string": r"^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$",
         "boolean": r"^BOOLEAN$", "object": r"^OBJECT.*", "array": r"^ARRAY.*"}


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, depth (null on or below a cycle) of calls with distinct ids."""
    own = calls.select("conv_id", "call_id", "parent_id")
    there = own.select(F.col("conv_id").alias("p_conv"), F.col("call_id").alias("p_id"))
    state = stored(own.join(there, (F.col("conv_id") == F.col("p_conv")) & (F.col("parent_id") == F.col("p_id")), "left")
                   .select("conv_id", "call_id", F.col("p_id").alias("up"), F.when(F.col("p_id").isNull(), 0).otherwise(1).cast("bigint").alias("depth")), "call-depths")
    left, before = state.filter("up is not null").count(), None
    while left and left != before:
        step = state.select(F.col("conv_id").alias("s_conv"), F.col("call_id").alias("s_id"), F.col("up").alias("s_up"), F.col("depth").alias("s_depth"))
        state = stored(state.join(step, (F.col("conv_id") == F.col("s_conv")) & (F.col("up") == F.col("s_id")), "left")
                       .select("conv_id", "call_id", F.col("s_up").alias("up"), (F.col("depth") + F.coalesce("s_depth", F.lit(0))).alias("depth")), "call-depths")
        left, before = state.filter("up is not null").count(), left
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def argument_faults(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, call_id, n_faults: arguments that are missing, of the wrong kind or not declared.

    ``schemas``: name, argument, type (a key of KINDS), required."""
    given = (calls.select("conv_id", "call_id", "name", F.explode(F.from_json("arguments", "map<string,variant>")).alias("argument", "value"))
             .select("conv_id", "call_id", "name", "argument", F.schema_of_variant("value").alias("kind")))
    declared = schemas.select(F.col("name").alias("t_name"), F.col("argument").alias("t_argument"), "type", "required")
    tools = schemas.select(F.col("name").alias("k_name")).distinct()
    fits = F.lit(False)
    for kind, pattern in KINDS.items():
        fits = F.when(F.col("type") == kind, F.col("kind").rlike(pattern)).otherwise(fits)
    wrong = (given.join(tools, F.col("name") == F.col("k_name")).join(declared, (F.col("name") == F.col("t_name")) & (F.col("argument") == F.col("t_argument")), "left")
             .filter(F.col("type").isNull() | ~F.coalesce(fits, F.lit(False))).select("conv_id", "call_id"))
    needed = calls.select("conv_id", "call_id", "name").join(declared.filter("required"), F.col("name") == F.col("t_name"))
    has = given.select(F.col("conv_id").alias("g_conv"), F.col("call_id").alias("g_id"), F.col("argument").alias("g_argument"))
    missing = (needed.join(has, (F.col("conv_id") == F.col("g_conv")) & (F.col("call_id") == F.col("g_id")) & (F.col("t_argument") == F.col("g_argument")), "left_anti")
               .select("conv_id", "call_id"))
    return wrong.unionByName(missing).groupBy("conv_id", "call_id").agg(F.count("*").alias("n_faults"))


def _beyond_first(rows: DataFrame, first: DataFrame, fields: list[str], times: str) -> DataFrame:
    """The rows (conv_id, call_id, fields) of ids that occur more than once, without the one that ``first`` names (``fields`` and the count ``times``).

    The repeated ids are stored by themselves, so Spark knows their size: if few, they go to the rows and only rows of such ids are shuffled.
    Equal rows are counted before they meet the first one, so a row given very often is one row until the end."""
    many = first.filter(F.col(times) > 1).select(F.col("conv_id").alias("m_conv"), F.col("call_id").alias("m_id"), F.struct(*fields).alias("m"))
    again = stored(many.select(F.col("m_conv").alias("conv_id"), F.col("m_id").alias("call_id")), "repeated-ids")
    counted = rows.join(again, ["conv_id", "call_id"], "left_semi").groupBy("conv_id", "call_id", *fields).agg(F.count("*").alias("copies"))
    met = counted.join(many, (F.col("conv_id") == F.col("m_conv")) & (F.col("call_id") == F.col("m_id")))
    left = F.col("copies") - F.struct(*fields).eqNullSafe(F.col("m")).cast("bigint")
    return met.withColumn("left", left).filter("left > 0").select(
        "conv_id", "call_id", *fields, F.explode(F.sequence(F.lit(1), F.col("left").cast("int"))).alias("nth")).drop("nth")


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """A row per call, per result without a call and per result beyond the first of its id.

    calls: conv_id, call_id, parent_id, turn, name, arguments (JSON text); results: conv_id, call_id, turn, content.
    Returns conv_id, call_id, turn, depth, name, status (linked, no_result, no_call, duplicate, extra_result), args_valid, n_results, json,
    and the texts as given: arguments and content (of the linked result, or of the row's own)."""
    calls = stored(calls.select("conv_id", "call_id", "parent_id", "turn", "name", "arguments"), "calls")
    keyed = calls.filter("conv_id is not null and call_id is not null")
    first = stored(keyed.groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "name", "arguments", "parent_id")).alias("c"), F.count("*").alias("times"))
        .select("conv_id", "call_id", "c.*", "times"), "first-calls")
    results = results.select("conv_id", "call_id", "turn", "content")
    answered = results.filter("conv_id is not null and call_id is not null")
    answer = (answered.groupBy("conv_id", "call_id")
              .agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
              .select(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_id"), F.col("r.turn").alias("r_turn"), "r.content", "n_results"))
    answer = stored(answer, "first-results")
    same = (F.col("conv_id") == F.col("r_conv")) & (F.col("call_id") == F.col("r_id"))
    deep = depths(first).withColumnsRenamed({"conv_id": "d_conv", "call_id": "d_id"})
    faults = argument_faults(first, schemas).withColumnsRenamed({"conv_id": "f_conv", "call_id": "f_id"})
    object_ = F.try_parse_json("arguments")
    is_object = F.coalesce(F.schema_of_variant(object_).startswith("OBJECT"), F.lit(False))
    linked = (first.join(answer, same, "left").join(deep, (F.col("conv_id") == F.col("d_conv")) & (F.col("call_id") == F.col("d_id")), "left")
              .join(faults, (F.col("conv_id") == F.col("f_conv")) & (F.col("call_id") == F.col("f_id")), "left")
              .withColumn("args_valid", is_object & F.col("n_faults").isNull())
              .withColumn("json", F.to_json(F.struct(object_.alias("arguments"), F.col("call_id").alias("id"), "name", F.col("parent_id").alias("parent"), F.col("content").alias("result"))))
              .select("conv_id", "call_id", "turn", "depth", "name", F.when(F.col("r_id").isNull(), "no_result").otherwise("linked").alias("status"),
                      "args_valid", F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"), "json", "arguments", "content"))

    def alone(df: DataFrame, status: str, count) -> DataFrame:
        own = {c: F.col(c) if c in df.columns else F.lit(None) for c in ("name", "arguments", "content")}
        return df.select("conv_id", "call_id", F.col("turn").cast("bigint").alias("turn"), F.lit(None).cast("bigint").alias("depth"), own["name"].cast("string").alias("name"),
                         F.lit(status).alias("status"), F.lit(None).cast("boolean").alias("args_valid"), count.cast("bigint").alias("n_results"),
                         F.lit(None).cast("string").alias("json"), own["arguments"].cast("string").alias("arguments"), own["content"].cast("string").alias("content"))

    orphans = (answer.join(first.select("conv_id", "call_id"), same, "left_anti")
               .select(F.col("r_conv").alias("conv_id"), F.col("r_id").alias("call_id"), F.col("r_turn").alias("turn"), "content", "n_results"))
    spare = _beyond_first(keyed, first, ["turn", "name", "arguments", "parent_id"], "times")
    chosen = answer.select(F.col("r_conv").alias("conv_id"), F.col("r_id").alias("call_id"), F.col("r_turn").alias("turn"), "content", "n_results")
    extra = _beyond_first(answered, chosen, ["turn", "content"], "n_results")
    unkeyed_calls = calls.filter("conv_id is null or call_id is null")
    unkeyed_results = results.filter("conv_id is null or call_id is null")
    return (linked.withColumn("turn", F.col("turn").cast("bigint"))
            .unionByName(alone(orphans, "no_call", F.col("n_results")))
            .unionByName(alone(spare, "duplicate", F.lit(0)))
            .unionByName(alone(extra, "extra_result", F.lit(0)))
            .unionByName(alone(unkeyed_calls, "no_result", F.lit(0)))
            .unionByName(alone(unkeyed_results, "no_call", F.lit(1))))
