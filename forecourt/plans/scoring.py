"""Scoring of requests with a classifier and a regressor, in a batch or on a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.config import Scope
from forecourt.functions.columns import outside_scope
from forecourt.operators.features import build_input_row
from forecourt.operators.lookups import impute_power


@dataclass(frozen=True)
class Valuer:
    """Two fitted pipelines that take the same feature columns, the price that divides the segments, and the table of
    typical powers (`lookups.power_medians`) for requests that do not know theirs."""

    classifier: PipelineModel
    regressor: PipelineModel
    threshold: float
    medians: DataFrame


MEDIANS = "level string, brand string, model string, fuel_type string, n bigint, median double"


def model_save(valuer: Valuer, spark: SparkSession, path: str) -> str:
    """Writes both pipelines, the threshold and the lookups under one path: a path is one version of all of them."""
    valuer.classifier.write().overwrite().save(f"{path}/classifier")
    valuer.regressor.write().overwrite().save(f"{path}/regressor")
    note = spark.range(1).select(
        F.lit(float(valuer.threshold)).alias("price_segment_threshold"),
        F.lit(1).alias("label_HIGH"), F.lit(0).alias("label_LOW"),
        F.lit("median price of the training rows").alias("derivation"),
        F.lit("divides the price segments when requests are scored").alias("note"),
    )
    note.coalesce(1).write.mode("overwrite").json(f"{path}/threshold")
    valuer.medians.select([c.split()[0] for c in MEDIANS.split(", ")]).write.mode("overwrite").parquet(f"{path}/medians")
    return path


def model_load(spark: SparkSession, path: str) -> Valuer:
    schema = "price_segment_threshold double, label_HIGH int, label_LOW int, derivation string, note string"
    note = spark.read.schema(schema).json(f"{path}/threshold").first()
    return Valuer(PipelineModel.load(f"{path}/classifier"), PipelineModel.load(f"{path}/regressor"),
                  note["price_segment_threshold"], spark.read.schema(MEDIANS).parquet(f"{path}/medians"))


def score_features(rows: DataFrame, valuer: Valuer, scope: Scope, keep=("request_id",)) -> DataFrame:
    """Price, segment, probabilities, confidence and scope flag. No shuffle, works on streams too."""
    given = rows.columns
    classed = valuer.classifier.transform(rows).withColumn("_p", vector_to_array("probability")).select(
        *given, F.col("prediction").cast("int").alias("segment"),
        F.element_at("_p", 1).alias("p_low"), F.element_at("_p", 2).alias("p_high"))
    priced = valuer.regressor.transform(classed).withColumnRenamed("prediction", "price")
    return priced.select(
        *keep, "price", "segment",
        F.when(F.col("segment") == 1, F.lit("HIGH")).otherwise(F.lit("LOW")).alias("segment_name"),
        "p_low", "p_high",
        F.when(F.col("segment") == 1, F.col("p_high")).otherwise(F.col("p_low")).alias("confidence"),
        outside_scope(F.col("price"), scope).alias("outside_scope"),
        F.lit(float(valuer.threshold)).alias("segment_threshold"),
    )


def score_listings(requests: DataFrame, valuer: Valuer, scope: Scope) -> DataFrame:
    """Scores a table or a stream of requests. An unknown power is looked up among the medians that were saved with the
    model, so no request fails for it and no batch reads the listings again."""
    powered = impute_power(requests, valuer.medians, scope).drop("power_from")
    return score_features(build_input_row(powered, scope), valuer, scope)
