"""The operators of this folder over the whole test tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import (
    decontamination,
    fill_middle,
    language,
    licences,
    lines,
    lm_scoring,
    near_dedup,
    negatives,
    neighbours,
    packing,
    personal,
    spotsigs,
    tool_calls,
)
from forecourt.llm.oracles import oracle_sql  # noqa: F401
from forecourt.llm.tables import importable


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = spotsigs.with_next(read(spark, sf_dir, "documents"))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    near = spotsigs.with_signatures(near.withColumn("edited", edited), "edited", "edited_signatures")
    own = F.col("signatures")
    return near.select(
        "doc_id", n.cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.fingerprint(own).alias("fingerprint"), spotsigs.fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        spotsigs.likeness(own, F.col("edited_signatures")).alias("near_edited"),
        spotsigs.likeness(own, F.col("next_signatures")).alias("near_next"), F.size(own).cast("bigint").alias("n_signatures"))


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(read(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.trained(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).select("doc_id", "text", "lang"))
    found = language.predicted(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_copies(read(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal.personal_data(docs, personal.trained(docs))
    base = F.filter("spans", lambda s: s["base"])
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, personal.KINDS), F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.packed(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = read(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    found = lm_scoring.scored(read(spark, sf_dir, "documents"), good)
    # Sums of logarithms depend on their order in the last digits.
    return found.withColumns({c: F.round(c, 6) for c in ("target_bits", "background_bits", "difference")})


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    hits = F.col("contamination")
    return found.select(
        "doc_id", hits["n_words"].alias("n_words"), hits["n_hit"].alias("n_hit"), F.size(hits["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(hits["items"]), ",").cast("binary"), 256).alias("items_sha256"),
        (hits["n_hit"] > 0).alias("contaminated"))


# Tools of the calls that turns stand for: name, param, type, required.
SCHEMAS = [("search", "query", "string", True), ("search", "limit", "integer", False),
           ("translate", "text", "string", True), ("translate", "to", "string", True),
           ("summarise", "text", "string", True), ("summarise", "words", "number", True)]


def tool_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and schemas: a user's turn stands for a call, an assistant's for the result of the turn before it.

    What a call asks for follows from the length n of its turn: the tool, the parent (the call two turns before), and
    faults: a limit that is text, a missing language, an argument too many, a tool without schema, broken JSON.
    """
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").withColumn("n", F.length("text"))
    n, mod = F.col("n"), lambda k: F.col("n") % k
    call = lambda at: F.concat(F.lit("call_"), at.cast("string"))
    name = F.when(mod(4) == 0, "search").when(mod(4) == 1, "translate").when(mod(4) == 2, "summarise").otherwise("lookup")
    text = F.col("text")
    as_json = F.when(mod(11) == 0, F.col("text")) \
        .when((mod(4) == 0) & (mod(7) == 0), F.to_json(F.struct(text.alias("query"), F.lit("many").alias("limit")))) \
        .when(mod(4) == 0, F.to_json(F.struct(text.alias("query"), mod(10).alias("limit")))) \
        .when((mod(4) == 1) & (mod(5) == 0), F.to_json(F.struct(text))) \
        .when(mod(4) == 1, F.to_json(F.struct(F.lit("en").alias("to"), text))) \
        .when((mod(4) == 2) & (mod(6) == 0), F.to_json(F.struct(n.alias("words"), text, F.lit(True).alias("brief")))) \
        .when(mod(4) == 2, F.to_json(F.struct(n.alias("words"), text))) \
        .otherwise(F.to_json(F.struct(text.alias("key"))))
    calls = turns.where("role = 'user'").select(
        "conv_id", call(F.col("turn")).alias("call_id"), F.when(mod(2) == 0, call(F.col("turn") - 2)).alias("parent_id"), "turn",
        name.alias("name"), as_json.alias("arguments"))
    results = turns.where("role = 'assistant'").select("conv_id", call(F.col("turn") - 1).alias("call_id"), "turn", text.alias("content"))
    return calls, results, spark.createDataFrame(SCHEMAS, "name string, param string, type string, required boolean")


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.linked_calls(*tool_tables(spark, sf_dir))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = fill_middle.transformed(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fim")
    hashed = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return fill_middle.restored(changed).select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", hashed("fim.output").alias("output_sha256"),
        hashed("restored").alias("restored_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.select("vec_id", "embedding", label.alias("label")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_fingerprints, op2_licence_scan, op3_language_id, op4_near_dedup, op5_personal_data, op6_packing, op7_lm_scoring,
        op8_line_dedup, op9_decontamination, op10_tool_calls, op11_neighbours, op12_fill_middle,
        op13_hard_negatives)}
