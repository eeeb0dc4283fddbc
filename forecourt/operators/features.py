"""Derived features, target and the checks that no test row leaks into training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.config import CATEGORICAL, FEATURES, NUMERIC, SEGMENT, TARGET, Scope
from forecourt.functions.columns import car_age, mileage_per_year, outside_scope, price_segment, year_midpoint
from forecourt.operators.ordering import overall_median


def with_car_age(df: DataFrame, scope: Scope) -> DataFrame:
    """Adds the age; the year itself would only repeat it and goes."""
    return df.withColumn("car_age", car_age(F.col("year").cast("double"), scope.reference_year)).drop("year")


def with_mileage_per_year(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "mileage_per_year", mileage_per_year(F.col("mileage_in_km").cast("double"), F.col("car_age")))


def feature_select_columns(df: DataFrame, scope: Scope, keep=()) -> DataFrame:
    """The eight features in their fixed order, after any columns to keep."""
    derived = with_mileage_per_year(with_car_age(df, scope))
    return derived.select(*keep, *CATEGORICAL, *[F.col(c).cast("double").alias(c) for c in NUMERIC])


def train_threshold(split: DataFrame) -> Column:
    """Median price of the training rows, as a scalar."""
    return overall_median(split.filter(F.col("split") == "train"), TARGET)


def with_price_segment(df: DataFrame, threshold: Column) -> DataFrame:
    return df.withColumn(SEGMENT, price_segment(F.col(TARGET), threshold))


def class_balance(labelled: DataFrame) -> DataFrame:
    """Rows and share of LOW and HIGH on both sides of the split."""
    return labelled.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(1 - F.col(SEGMENT)).alias("share_low"),
        F.avg(F.col(SEGMENT)).alias("share_high"),
    )


def scope_flag(df: DataFrame, price: str, scope: Scope) -> DataFrame:
    return df.withColumn("outside_scope", outside_scope(F.col(price), scope))


def input_bounds(requests: DataFrame, scope: Scope) -> DataFrame:
    """Adds the reasons why a request is not allowed and whether it is valid. No reason, valid."""
    low, high = scope.request_year
    year_ok = (F.col("min_year") >= low) & (F.col("max_year") <= high) & (F.col("min_year") <= F.col("max_year"))
    # An unknown power is allowed: it is estimated later.
    power_ok = F.col("power_ps").isNull() | F.col("power_ps").between(*scope.request_power)
    mileage_ok = F.col("mileage_in_km").between(*scope.request_mileage)
    wrong = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
             for ok, name in ((year_ok, "year"), (power_ok, "power"), (mileage_ok, "mileage"))]
    return requests.withColumn("rejected_for", F.concat_ws(",", *wrong)).withColumn(
        "valid", F.col("rejected_for") == "")


def split_requests(requests: DataFrame, scope: Scope) -> tuple[DataFrame, DataFrame]:
    """Allowed requests and the rejected ones with their reasons."""
    checked = input_bounds(requests, scope)
    return checked.filter("valid").drop("valid", "rejected_for"), checked.filter("not valid").drop("valid")


def with_midpoint(requests: DataFrame) -> DataFrame:
    return requests.withColumn("year", year_midpoint(F.col("min_year"), F.col("max_year")))


def build_input_row(requests: DataFrame, scope: Scope, keep=("request_id",)) -> DataFrame:
    """Requests as feature rows, through the same expressions as the training data."""
    return feature_select_columns(with_midpoint(requests), scope, keep)


def leakage_checks(labelled: DataFrame, threshold: Column, scaler_means: dict[str, float] | None = None) -> DataFrame:
    """Named checks with the value expected, the value found and the verdict.

    `threshold` and `scaler_means` are those stored with a model: they are held against the rows themselves.
    """
    train, everything = labelled.filter(F.col("split") == "train"), labelled
    lines = [
        F.struct(F.lit(f"{c} not a feature").alias("check"), F.lit(0.0).alias("expected"),
                 F.lit(float(c in FEATURES)).alias("actual"))
        for c in (TARGET, SEGMENT, "year")
    ]
    lines.append(F.struct(F.lit("threshold is the train median").alias("check"),
                          overall_median(train, TARGET).alias("expected"), threshold.alias("actual")))
    means = train.agg(F.struct(*[F.avg(c).alias(c) for c in NUMERIC])).scalar()
    for c in NUMERIC:
        fitted = F.lit(scaler_means[c]) if scaler_means else means[c]
        lines.append(F.struct(F.lit(f"scaler mean of {c} is the train mean").alias("check"),
                              means[c].alias("expected"), fitted.alias("actual")))
    same = everything.sparkSession.range(1).select(F.inline(F.array(*lines))).withColumn(
        "passed", F.abs(F.col("expected") - F.col("actual")) < 1e-4)
    # The same figures over all rows must differ, or the comparison above would prove nothing.
    all_means = everything.agg(F.struct(*[F.avg(c).alias(c) for c in NUMERIC])).scalar()
    differ = [F.struct(F.lit("threshold differs from the median of all rows").alias("check"),
                       overall_median(everything, TARGET).alias("expected"), threshold.alias("actual"))]
    for c in NUMERIC:
        fitted = F.lit(scaler_means[c]) if scaler_means else means[c]
        differ.append(F.struct(F.lit(f"scaler mean of {c} differs from the mean of all rows").alias("check"),
                               all_means[c].alias("expected"), fitted.alias("actual")))
    other = everything.sparkSession.range(1).select(F.inline(F.array(*differ))).withColumn(
        "passed", F.col("expected") != F.col("actual"))
    return same.unionByName(other)
