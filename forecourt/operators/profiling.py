"""Profiles: missing values, summaries, counts, histograms, shape and correlation."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.config import MEASURES
from forecourt.operators.ordering import group_medians, group_quantiles


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values of every column, from one scan."""
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(f"`{c}`").isNull()).alias("missing"),
            F.try_divide(F.count_if(F.col(f"`{c}`").isNull()) * F.lit(100.0), F.count(F.lit(1))).alias("missing_pct"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row. Copies are merged before the shuffle."""
    return (
        df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
        .select("n_rows", (F.col("n_rows") - F.col("n_distinct")).alias("duplicates"))
    )


def long_form(df: DataFrame, columns) -> DataFrame:
    return df.unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "column_name", "value")


def numeric_summary(df: DataFrame, columns=MEASURES) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of each column."""
    tall = long_form(df, columns)
    moments = tall.groupBy("column_name").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    at = lambda s: F.max(F.when(F.col("share") == s, F.col("quantile")))
    quartiles = group_quantiles(tall, ["column_name"], "value", [0.25, 0.5, 0.75]).groupBy("column_name").agg(
        at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75"))
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def value_range(df: DataFrame, columns=("year", "power_ps", "mileage_in_km")) -> DataFrame:
    lines = [F.struct(F.lit(c).alias("column_name"), F.min(c).cast("double").alias("lowest"),
                      F.max(c).cast("double").alias("highest")) for c in columns]
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def distinct_counts(df: DataFrame, columns, approximate: bool = False) -> DataFrame:
    """Distinct values without NULL. The exact form merges equal values before the shuffle."""
    if approximate:
        lines = [F.struct(F.lit(c).alias("column_name"), F.approx_count_distinct(c).alias("n_distinct"))
                 for c in columns]
        return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))
    tall = df.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "column_name", "value")
    return (
        tall.groupBy("column_name", "value").agg(F.lit(1).alias("one"))
        .groupBy("column_name").agg(F.count("value").alias("n_distinct"))
    )


def category_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts, largest first, equal counts by value; optionally the first few only."""
    counts = (
        df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
    )
    return counts if top is None else counts.limit(top)


def category_share(df: DataFrame, column: str, decimals: int = 1) -> DataFrame:
    """Counts with their share of all rows in percent."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    return category_counts(df, column).withColumn("share_pct", F.round(F.col("n") * F.lit(100.0) / rows, decimals))


def year_counts(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("year").isNotNull()).groupBy(F.col("year").cast("int").alias("year"))
        .agg(F.count(F.lit(1)).alias("n")).orderBy("year")
    )


def histogram(df: DataFrame, value, bins: int) -> DataFrame:
    """Counts in equal steps from the smallest to the largest value; the last step is closed."""
    values = df.select(value.cast("double").alias("x")).filter(F.col("x").isNotNull())
    ends = values.agg(F.min("x").alias("a"), F.max("x").alias("b"))
    # A single value gets a range of its own. One row of ends for all rows: the only subquery.
    half = F.when(F.col("a") == F.col("b"), 0.5).otherwise(0.0)
    ends = ends.select(F.struct((F.col("a") - half).alias("lo"), (F.col("b") + half).alias("hi")).alias("ends")).scalar()
    values = values.withColumn("ends", ends).select("x", "ends.lo", "ends.hi")
    lo, hi = F.col("lo"), F.col("hi")
    edge = lambda i: F.when(i == bins, hi).otherwise(lo + i * ((hi - lo) / bins))
    guess = F.least(F.floor((F.col("x") - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    # The division may land one step off at an edge, so the edges themselves decide.
    step = F.col("guess")
    placed = values.withColumn("guess", guess).select(
        "lo", "hi", F.when(F.col("x") < edge(step), step - 1)
        .when((F.col("x") >= edge(step + 1)) & (step < bins - 1), step + 1)
        .otherwise(step).alias("bin"))
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    # Empty steps have the ends of the others, a table without values none.
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    whole = Window.partitionBy()
    full = every.join(counts, "bin", "left").select(
        "bin", F.coalesce("n", F.lit(0)).alias("n"), F.max("lo").over(whole).alias("lo"), F.max("hi").over(whole).alias("hi"))
    return full.select("bin", edge(F.col("bin")).alias("lower"), edge(F.col("bin") + 1).alias("upper"), "n")


def log_price(df: DataFrame) -> DataFrame:
    return df.withColumn("log_price", F.log1p("price_in_euro"))


def adjusted_skewness(column):
    """Sample-adjusted skewness; the built-in aggregate is the population form. NULL below three rows."""
    n = F.count(column).cast("double")
    g1 = F.when(F.var_pop(column) > 0, F.skewness(column)).otherwise(F.lit(0.0))
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2))


def skewness(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Skewness of the price before cleaning, after cleaning, and of its logarithm."""
    price = F.col("price_in_euro").cast("double")
    before = raw.agg(F.lit("raw").alias("price"), adjusted_skewness(price).alias("skewness"))
    after = clean.agg(F.array(
        F.struct(F.lit("clean").alias("price"), adjusted_skewness(price).alias("skewness")),
        F.struct(F.lit("log clean").alias("price"), adjusted_skewness(F.log1p(price)).alias("skewness")),
    ).alias("lines")).select(F.inline("lines"))
    return before.unionByName(after)


def group_median(df: DataFrame, key: str = "fuel_type", value: str = "price_in_euro") -> DataFrame:
    """Median per group, highest first."""
    return group_medians(df, [key], value, name="median_price").orderBy(F.desc("median_price"), key)


def correlation_matrix(df: DataFrame, columns=MEASURES) -> DataFrame:
    """Pearson correlation of every pair of columns, one scan."""
    lines = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                      F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"))
             for a, b in product(columns, columns)]
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def quantiles(df: DataFrame, column: str = "year", shares=(0.25, 0.5)) -> DataFrame:
    return group_quantiles(df, [], column, list(shares)).select("share", "quantile")


def feature_summary(features: DataFrame) -> DataFrame:
    """Range and mean of the age, range and median of the yearly mileage."""
    middle = group_quantiles(features, [], "mileage_per_year", [0.5]).select("quantile").scalar()
    return features.agg(
        F.min("car_age").alias("min_age"), F.max("car_age").alias("max_age"), F.avg("car_age").alias("mean_age"),
        F.min("mileage_per_year").alias("min_km_per_year"), F.max("mileage_per_year").alias("max_km_per_year"),
        middle.alias("median_km_per_year"),
    )

