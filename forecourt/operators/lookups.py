"""Lookups that a valuation request needs: options, a typical power, the standing of a brand.

The lookup side is always one row per group. No broadcast is forced: Spark sees the finished size of that
side at run time and broadcasts it when it is small, or shuffles and splits hot keys when it is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.config import Scope
from forecourt.operators.ordering import group_medians, group_quantiles, overall_median
from forecourt.operators.profiling import long_form


def brand_model_options(listings: DataFrame) -> DataFrame:
    """Brands with their models, both sorted. One row per pair travels, not one per listing."""
    pairs = listings.select("brand", "model").dropna().distinct()
    return pairs.groupBy("brand").agg(F.sort_array(F.collect_list("model")).alias("models"))


#: The groups that can tell a typical power, the narrowest first, and the columns that name them.
LEVELS = (("fuel", ("brand", "model", "fuel_type")), ("model", ("brand", "model")), ("brand", ("brand",)), ("all", ()))


def power_medians(sample: DataFrame, least: int = 3) -> DataFrame:
    """The median power of every group that has enough rows, and of all rows: level, its names, n, median.

    It is a table of a row for each group, made once and saved with a model; requests meet it instead of the listings.
    Names that a level doesn't use are empty. A row with a missing name is in the groups that do not need it.
    """
    parts = LEVELS[0][1]
    places = F.array(*[F.struct(F.lit(level).alias("level"), *[(F.col(c) if c in keys else F.lit("")).alias(c) for c in parts])
                       for level, keys in LEVELS])
    rows = sample.where("power_ps IS NOT NULL").select(F.explode(places).alias("place"), "power_ps").select("place.*", "power_ps")
    medians = group_medians(rows, ["level", *parts], "power_ps")
    return medians.where((F.col("n") >= least) | (F.col("level") == "all"))


def impute_power(requests: DataFrame, medians: DataFrame, scope: Scope) -> DataFrame:
    """Fills a missing power with the median of the narrowest group that `power_medians` has for the request.

    `power_from` names the group used, or `request`, or `default`. Works on streams: the medians are the static side.
    """
    filled = requests
    for level, keys in LEVELS:
        found = medians.where(F.col("level") == level)
        if keys:
            filled = filled.join(found.select(*keys, F.col("median").alias(f"_{level}")), list(keys), "left")
        else:
            filled = filled.withColumn(f"_{level}", found.agg(F.max("median")).scalar())
    sources = [("request", "power_ps"), *[(level, f"_{level}") for level, _ in LEVELS]]
    origin = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(name)) for name, c in sources], F.lit("default"))
    value = F.coalesce(*[F.col(c).cast("double") for _, c in sources], F.lit(scope.default_power))
    return filled.withColumn("power_from", origin).withColumn("power_ps", value).select(*requests.columns, "power_from")


def fuel_options(requests: DataFrame, sample: DataFrame, scope: Scope) -> DataFrame:
    """Fuels on offer for the brand and model, else for the brand, else all of them."""
    seen = sample.select("brand", "model", "fuel_type").distinct()
    by_model = seen.groupBy("brand", "model").agg(F.sort_array(F.collect_set("fuel_type")).alias("_of_model"))
    by_brand = seen.groupBy("brand").agg(F.sort_array(F.collect_set("fuel_type")).alias("_of_brand"))
    found = F.coalesce("_of_model", "_of_brand")
    every = F.array(*[F.lit(f) for f in scope.fuels])
    return (
        requests.join(by_model, ["brand", "model"], "left").join(by_brand, ["brand"], "left")
        .withColumn("fuels", F.when(F.size(F.coalesce(found, F.array().cast("array<string>"))) > 0, found)
                    .otherwise(every))
        .select(*requests.columns, "fuels")
    )


def brand_context(sample: DataFrame, least: int = 10, above: float = 1.2, below: float = 0.85) -> DataFrame:
    """Median price per brand against the median of all; brands with few rows get no verdict."""
    ctx = group_medians(sample, ["brand"], "price_in_euro", "brand_median").withColumn(
        "overall_median", overall_median(sample, "price_in_euro"))
    enough = F.col("n") >= least
    verdict = (
        F.when(enough & (F.col("brand_median") > F.col("overall_median") * above), F.lit("above"))
        .when(enough & (F.col("brand_median") < F.col("overall_median") * below), F.lit("below"))
    )
    return ctx.withColumn("standing", verdict)


def sample_medians(sample: DataFrame, columns=("mileage_in_km", "year", "power_ps", "price_in_euro")):
    """Medians of several columns as one scalar struct."""
    found = group_quantiles(long_form(sample, columns), ["column_name"], "value", [0.5])
    fields = [F.max(F.when(F.col("column_name") == c, F.col("quantile"))).alias(c) for c in columns]
    return found.agg(F.struct(*fields)).scalar()
