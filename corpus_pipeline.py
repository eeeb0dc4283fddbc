"""Raw documents to packed training sequences in five stages, each written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import decontamination, language, lines, near_dedup, packing
from forecourt.llm.queries import read
from forecourt.llm.tables import importable
from forecourt.sources.storage import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; null texts, texts without letters and texts that two languages
    code about equally well (a score under 0.5) go."""
    importable(spark)
    names = docs.columns
    model = language.trained(docs.where(~language.held_out()).select("doc_id", "text", "lang"))
    found = language.predicted(docs, model, into=("stage_lang", "stage_score"))
    return found.where((F.col("stage_lang") != language.UNKNOWN) & (F.col("stage_score") >= 0.5)).select(names)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier line; n_chars follows the text. Documents with no line left go."""
    importable(spark)
    names = docs.columns
    found = lines.without_repeats(docs, into="stage_lines")
    left = found.where(F.col("stage_lines.n_dropped").eqNullSafe(0) | (F.col("stage_lines.n_dropped") < F.col("stage_lines.n_lines")))
    if "n_chars" in names:
        left = left.withColumn("n_chars", F.when(F.col("stage_lines.n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                               .otherwise(F.col("n_chars")))
    return left.select(names)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies, by the operator's own sets of word pairs.

    Rows that repeat a doc_id are one document: the one with the smallest text stays, of equal texts the first by its
    other columns.
    """
    importable(spark)
    found = written(near_dedup.near_copies(docs).select("doc_id", "kept"), "kept")
    left = docs.join(found.where("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)
    again = written(found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "again")
    if again.isEmpty():
        return left
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = left.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(row, F.struct("text", F.to_json(row))).alias("first"))
    return left.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(first.select("first.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    names = docs.columns
    found = decontamination.contamination(docs, read(spark, sf_dir, "benchmark"), into="stage_hits")
    return found.where(F.col("stage_hits.n_hit") == 0).select(names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 tokens."""
    import public_tokenizers

    importable(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_copies),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Language models, SimHash, tokens and packing are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of `documents`, every stage written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
