"""Splits, folds and samples by hashing a row key: repeatable, and the same under any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.config import Seeds
from forecourt.functions.columns import unit_hash
from forecourt.operators.ordering import hash_rank


def train_test_split(df: DataFrame, key: str, seeds: Seeds = Seeds()) -> DataFrame:
    """Adds `split`. Rows with equal keys land on the same side. No shuffle."""
    cut = f"{2 ** 32 * seeds.test_percent // 100:08x}"
    side = F.substring(unit_hash(F.col(key), "split", seeds.seed), 1, 8) < cut
    return df.withColumn("split", F.when(side, F.lit("test")).otherwise(F.lit("train")))


def stratified_split(df: DataFrame, strata, key: str, seeds: Seeds = Seeds()) -> DataFrame:
    """Adds `split` with the exact test share inside every stratum, rounded down."""
    hashed = df.withColumn("_digest", unit_hash(F.col(key), "strata", seeds.seed))
    ranked = hash_rank(hashed, strata, "_digest", key, "_rank", "_size")
    side = F.col("_rank") * 100 <= F.col("_size") * seeds.test_percent
    return ranked.withColumn("split", F.when(side, F.lit("test")).otherwise(F.lit("train"))).drop(
        "_digest", "_rank", "_size")


def fold_assign(df: DataFrame, key: str, strata=(), seeds: Seeds = Seeds()) -> DataFrame:
    """Adds `fold`, 0 to folds-1, of sizes that differ by one at most, inside every stratum."""
    hashed = df.withColumn("_digest", unit_hash(F.col(key), "fold", seeds.seed))
    return hash_rank(hashed, list(strata), "_digest", key, "_rank", "_size").withColumn(
        "fold", (F.pmod(F.col("_rank") - 1, F.lit(seeds.folds))).cast("int")).drop("_digest", "_rank", "_size")


def sample_rows(df: DataFrame, n: int, key: str, seeds: Seeds = Seeds()) -> DataFrame:
    """n rows without replacement, those with the smallest hashes.

    Sorting for a limit would send n rows from every task to one. So rows are first counted by the size
    of their hash in powers of two, about fifty counts, and only the smallest powers that together hold n
    rows are sorted: fewer than about 2 n rows, whatever the size of the table.
    """
    hashed = df.withColumn("_digest", unit_hash(F.col(key), "sample", seeds.seed)).withColumn(
        "_power", F.expr("cast(ceil(log2(cast(conv(substr(_digest, 1, 12), 16, 10) AS bigint) + 1)) AS int)"))
    upto = Window.orderBy("_power").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = hashed.groupBy("_power").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(upto))
    # NULL when there are no n rows: then all are taken.
    last = counts.agg(F.min(F.when(F.col("upto") >= n, F.col("_power")))).scalar()
    return (
        hashed.filter(F.coalesce(F.col("_power") <= last, F.lit(True)))
        .orderBy("_digest", key).limit(n).drop("_digest", "_power")
    )
