"""Tool calls of conversations: linked with their results, put in order, checked against schemas, as canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.sources.storage import written

_WHOLE = r"^DECIMAL\(\d+,0\)$"
_KEY = ["conv_id", "call_id"]


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): the number of calls that must come before a call, one after the other; null for those
    on or behind a cycle.

    Every call points to its parent. In each round a pointer takes over where its target points to, so a chain of n
    calls takes log2(n) rounds. Calls that no round reaches any more wait for themselves.
    """
    known = calls.select(*_KEY).withColumnRenamed("call_id", "parent_id")
    state = calls.join(known.withColumn("there", F.lit(True)), ["conv_id", "parent_id"], "left").select(
        *_KEY, F.when(F.col("there"), F.col("parent_id")).alias("up"), F.when(F.col("there"), 1).otherwise(0).cast("bigint").alias("level"))
    state, open_ = written(state, "levels"), None
    while True:
        left = state.where("up is not null").count()
        if left == 0 or left == open_:
            return state.select(*_KEY, F.when(F.col("up").isNull(), F.col("level")).alias("level"))
        open_ = left
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("level").alias("more"))
        moved = state.where("up is not null").join(above, ["conv_id", "up"]).select(
            *_KEY, F.col("next").alias("up"), (F.col("level") + F.col("more")).alias("level"))
        state = written(state.where("up is null").unionByName(moved), "levels")


def linked_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """A row for each call and each result without a call: conv_id, call_id, turn, name, level, status, errors, message.

    `calls` has conv_id, call_id, parent_id (a call of the same conversation whose result this one uses, or null),
    turn, name and arguments (JSON); `results` conv_id, call_id, turn and content; `schemas` name, param, type (string,
    integer, number, boolean, array, object) and required. Calls meet results by hash join on conversation and id.
    `level` puts them in an order in which every call follows its parent: by level, then turn, then id.
    `status` is linked, unanswered, orphan (a result without call) or cycle. `errors` lists, in order: arguments that
    are no JSON object, a tool without schema, missing, unknown and mistyped arguments, a parent that does not exist, a
    result before its call. `message` is canonical JSON.

    Of repeated call ids or results of a conversation the one with the smallest turn (then smallest text) counts.
    Of repeated rows of a parameter the first by type, then the one not required, counts; a null `required` is false, a
    row with a null param only says that the tool has a schema, and one with a null name says nothing. Whole numbers
    of up to 38 digits are integers. Rows without conversation or id are left out. Null arguments are no JSON object; null content is null. No rows: no
    rows. No conversation is gathered: a row is a call, and a long conversation is as many rows.
    """
    one = lambda df, cols: df.where("conv_id is not null and call_id is not null").groupBy(*_KEY).agg(
        F.min(F.struct("turn", *cols)).alias("one")).select(*_KEY, "one.*")
    asked = written(one(calls, ["name", "arguments", "parent_id"]), "calls")
    given = one(results, ["content"]).select(*_KEY, F.col("turn").alias("result_turn"), "content", F.lit(True).alias("answered"))
    ruled_by = schemas.where("name is not null").groupBy("name", "param").agg(
        F.min(F.struct("type", F.coalesce("required", F.lit(False)).alias("required"))).alias("rule"))
    rules = ruled_by.groupBy("name").agg(F.map_from_entries(F.collect_list(
        F.when(F.col("param").isNotNull(), F.struct("param", "rule")))).alias("rules"))
    parents = asked.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("parent_there"))
    both = asked.withColumn("asked", F.lit(True)).join(given, _KEY, "full") \
        .join(_levels(asked), _KEY, "left").join(parents, ["conv_id", "parent_id"], "left").join(rules, "name", "left")

    raw = F.try_parse_json("arguments")
    kind = F.schema_of_variant(raw)
    both = both.withColumn("object", kind.startswith("OBJECT")).withColumn(
        "given", F.when(F.col("object"), raw.cast("map<string,variant>")))
    names = F.array_sort(F.map_keys("given"))

    def typed(v: Column, wanted: Column) -> Column:
        found = F.schema_of_variant(v)
        return F.when(wanted == "string", found == "STRING").when(wanted == "integer", (found == "BIGINT") | found.rlike(_WHOLE)) \
            .when(wanted == "number", found.isin("BIGINT", "DOUBLE", "FLOAT") | found.startswith("DECIMAL")) \
            .when(wanted == "boolean", found == "BOOLEAN").when(wanted == "array", found.startswith("ARRAY")) \
            .when(wanted == "object", found.startswith("OBJECT")).otherwise(F.lit(False))

    ruled = F.array_sort(F.map_keys("rules"))
    each = lambda which, text: F.transform(which, lambda p: F.concat(F.lit(text), p))
    missing = each(F.filter(ruled, lambda p: F.col("rules")[p]["required"] & ~F.array_contains(names, p)), "missing:")
    unknown = each(F.filter(names, lambda p: ~F.array_contains(F.map_keys("rules"), p)), "unknown:")
    mistyped = each(F.filter(names, lambda p: F.array_contains(F.map_keys("rules"), p)
                             & ~F.coalesce(typed(F.col("given")[p], F.col("rules")[p]["type"]), F.lit(False))), "type:")
    none = F.array().cast("array<string>")
    say = lambda when, text: F.when(when, F.array(F.lit(text))).otherwise(none)
    bad = ~F.coalesce("object", F.lit(False))
    errors = F.when(F.col("asked").isNull(), none).otherwise(F.concat(
        say(bad, "arguments"), say(F.col("rules").isNull(), "tool"),
        F.when(bad | F.col("rules").isNull(), none).otherwise(F.concat(missing, unknown, mistyped)),
        say(F.col("parent_id").isNotNull() & F.col("parent_there").isNull(), "parent"),
        say(F.coalesce(F.col("result_turn") < F.col("turn"), F.lit(False)), "early")))
    status = F.when(F.col("asked").isNull(), "orphan").when(F.col("level").isNull(), "cycle") \
        .when(F.col("answered").isNull(), "unanswered").otherwise("linked")
    # Fields in the order of their names; a variant writes its own names in order.
    message = F.to_json(F.struct(raw.alias("arguments"), F.col("call_id").alias("id"), "name", F.col("content").alias("result")),
                        {"ignoreNullFields": "false"})
    return both.select("conv_id", "call_id", F.coalesce("turn", "result_turn").alias("turn"), "name", "level", status.alias("status"),
                       F.array_join(errors, ",").alias("errors"), message.alias("message"))
