"""Profiles of data that arrives in loads.

A load is read once, into a row for each column: counts, moments, and two sketches, of its values and of how many differ.
The profile of all loads is made of those rows; no load is read again when another one arrives, and a load that arrives
twice replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sizes of the sketches. A quantile's rank is off by at most RANK_ERROR of the values in 99 of 100 cases, a count of
#: different values by at most DISTINCT_ERROR of itself (three deviations).
VALUES_K, DISTINCT_LOG = 2000, 14
RANK_ERROR, DISTINCT_ERROR = 0.0025, 0.025

SCHEMA = ("load string, column_name string, rows bigint, missing bigint, n bigint, mean double, squares double, min double, "
          "max double, value_sketch binary, distinct_sketch binary")


def load_profile(df: DataFrame, load: str, columns=None) -> DataFrame:
    """A row for each column of a load, from one pass. Text columns have counts and the sketch of different values only."""
    lines = []
    for c in columns or df.columns:
        col, number = F.col(f"`{c}`"), isinstance(df.schema[c].dataType, T.NumericType)
        value = F.nanvl(col.cast("double"), F.lit(None)) if number else F.lit(None).cast("double")
        known = value if number else col
        lines.append(F.struct(
            F.lit(load).alias("load"), F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("rows"), F.count_if(known.isNull()).alias("missing"),
            F.count(known).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("squares"),
            F.min(value).alias("min"), F.max(value).alias("max"),
            (F.kll_sketch_agg_double(value, VALUES_K) if number else F.lit(None).cast("binary")).alias("value_sketch"),
            F.hll_sketch_agg(known.cast("string"), DISTINCT_LOG).alias("distinct_sketch")))
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def add_load(df: DataFrame, load: str, path: str, columns=None) -> None:
    """Profiles a load into the table under `path`."""
    load_profile(df, load, columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/{load}")


def loads(spark: SparkSession, path: str) -> DataFrame:
    """The profiled loads: a row for each load and column."""
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(path)


def merged_profile(profiles: DataFrame, shares=(0.25, 0.5, 0.75)) -> DataFrame:
    """One row for each column over all loads: rows, missing, n, mean, std, min, max, `quantiles` at the shares, and `different`.

    Counts and extremes are those of one pass over everything, moments up to rounding; quantiles and `different` are
    within the stated errors. Columns that are missing throughout have no moments.
    """
    # The squares of a load are about its own mean: what the means differ by is added.
    whole = F.sum(F.col("n") * F.col("mean")).over(Window.partitionBy("column_name")) / F.sum(
        F.when(F.col("mean").isNotNull(), F.col("n"))).over(Window.partitionBy("column_name"))
    around = F.col("squares") + F.col("n") * F.pow(F.col("mean") - F.col("_whole"), 2)
    merged = profiles.withColumn("_whole", whole).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("loads"), F.sum("rows").alias("rows"), F.sum("missing").alias("missing"), F.sum("n").alias("n"),
        F.max("_whole").alias("mean"), F.sum(around).alias("_squares"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double(F.when(F.col("mean").isNotNull(), F.col("value_sketch"))).alias("_values"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("different"))
    quantiles = F.when(F.col("mean").isNotNull(), F.array(*[F.kll_sketch_get_quantile_double("_values", F.lit(s)) for s in shares]))
    return merged.select(
        "column_name", "loads", "rows", "missing", F.try_divide(F.col("missing") * F.lit(100.0), F.col("rows")).alias("missing_pct"), "n", "mean",
        F.sqrt(F.try_divide(F.col("_squares"), F.col("n") - 1)).alias("std"), "min", "max", quantiles.alias("quantiles"), "different")
