"""Two scored requests side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_pairs(pairs: DataFrame, scored: DataFrame) -> DataFrame:
    """Price difference B minus A, its percentage of A (0 unless A is above 0), the verdict and the status.

    `pairs`: pair_id, request_a, request_b. `scored`: request_id, price, segment, confidence. Every pair has a row;
    one with a request that was not scored says so and has no difference.
    """
    side = lambda s: scored.select(
        F.col("request_id").alias(f"request_{s}"), F.col("price").alias(f"price_{s}"),
        F.col("segment").alias(f"segment_{s}"), F.col("confidence").alias(f"confidence_{s}"))
    diff = F.col("price_b") - F.col("price_a")
    return (
        pairs.join(side("a"), "request_a", "left").join(side("b"), "request_b", "left")
        .withColumn("difference", diff)
        .withColumn("difference_pct",
                    F.when(diff.isNull(), None).when(F.col("price_a") > 0,
                           diff / F.when(F.col("price_a") > 0, F.col("price_a")) * 100).otherwise(F.lit(0.0)))
        .withColumn("verdict", F.when(F.abs(diff) < 1, F.lit("same"))
                    .when(diff > 0, F.lit("b dearer")).when(diff < 0, F.lit("a dearer")))
        .withColumn("status", F.when(F.col("price_a").isNull() & F.col("price_b").isNull(), F.lit("neither scored"))
                    .when(F.col("price_a").isNull(), F.lit("a not scored"))
                    .when(F.col("price_b").isNull(), F.lit("b not scored")).otherwise(F.lit("compared")))
        .select("pair_id", "request_a", "request_b", "price_a", "price_b", "segment_a", "segment_b",
                "confidence_a", "confidence_b", "difference", "difference_pct", "verdict", "status")
    )
