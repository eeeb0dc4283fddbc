"""The test tables seen as listings, valuation requests and pairs of requests.

A line item with its part is a listing; a part is a request. Some discount and tax combinations stand
for a field that the raw file has wrong, so that every cleaning rule has something to remove.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.config import SEGMENT, TARGET, Scope, Seeds
from forecourt.operators.cleaning import bound, clean_listings, default_rules
from forecourt.operators.features import feature_select_columns, train_threshold, with_price_segment
from forecourt.operators.splitting import train_test_split

# The bounds of a general-market listing on the scale of the test tables.
SCOPE = Scope(
    reference_year=2001, year_min=1996, price_min=2000.0, price_max=80000.0, power_min=2.0, power_max=48.0,
    mileage_max=49.0, mileage_excluded=1.0, fuels=("Diesel Hybrid", "Electric", "LARGE", "SMALL", "STANDARD"),
    request_year=(1996, 2001), request_power=(2.0, 48.0), request_mileage=(1.0, 49.0), default_power=25.0,
)
SEEDS = Seeds()
RULES = default_rules


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def listing_id() -> Column:
    """Digest of what tells line items apart. Doubles go in as cents: engines print doubles differently."""
    return F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             cents("l_quantity"), cents("l_extendedprice")))


def fuel() -> Column:
    """Part types, two of them under names that the explanations know."""
    return F.when(F.col("p_type") == "ECONOMY", F.lit("Electric")).when(F.col("p_type") == "MEDIUM", F.lit("Diesel Hybrid")) \
        .otherwise(F.col("p_type"))


def price() -> Column:
    """One brand is dear and one is cheap. Doubling and halving leave all digits as they are."""
    return F.col("l_extendedprice") * F.when((F.col("p_brand") == "Brand#25") & (F.col("l_extendedprice") < 40000), 2.0).when(
        F.col("p_brand") == "Brand#5", 0.5).otherwise(1.0)


def wrong(discount: float, tax: float) -> Column:
    return (F.col("l_discount") == discount) & (F.col("l_tax") == tax)


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))


def _common() -> dict[str, Column]:
    return {
        "brand": F.col("p_brand"),
        "model": F.concat_ws(" ", "p_brand", "p_name"),
        "transmission_type": F.when(~wrong(0.0, 0.01), F.when(F.col("l_returnflag") == "N", F.lit("Unknown"))
                                    .otherwise(F.col("l_returnflag"))),
        "fuel_type": F.when(wrong(0.0, 0.04), F.lit("07/2010")).when(~wrong(0.1, 0.04), fuel()),
    }


def _numbers() -> dict[str, Column]:
    return {
        "year": F.when(~wrong(0.0, 0.08), F.year("l_shipdate").cast("double")),
        "price_in_euro": F.when(~wrong(0.0, 0.0), price()),
        "power_ps": F.when(~wrong(0.1, 0.0), F.col("p_size").cast("double")),
        "mileage_in_km": F.when(~wrong(0.1, 0.08), F.col("l_quantity")),
    }


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings with numbers already read: what does not count as a number is NULL."""
    rows = joined(spark, sf_dir).select(
        listing_id().alias("listing_id"), *[c.alias(n) for n, c in {**_common(), **_numbers()}.items()],
        F.col("l_linestatus").alias("color"), F.col("p_name").alias("offer_description"))
    return bound(rows, [n for n in rows.columns if n not in ("brand", "color", "offer_description")])


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same listings as a raw file has them: text only, with junk in the wrong fields."""
    junk = F.when(F.col("l_linenumber") < 3, F.lit("abc")).when(F.col("l_linenumber") < 5, F.lit("")).otherwise(
        F.lit("NaN"))
    texts = {n: F.coalesce(c.cast("string"), junk) for n, c in _numbers().items()}
    other = {
        "Unnamed: 0": F.col("l_orderkey").cast("string"),
        "color": F.col("l_linestatus"),
        "registration_date": F.date_format("l_shipdate", "MM/yyyy"),
        "power_kw": F.col("p_size").cast("string"),
        "fuel_consumption_l_100km": F.col("l_discount").cast("string"),
        "fuel_consumption_g_km": F.col("l_tax").cast("string"),
        "offer_description": F.col("p_name"),
    }
    return joined(spark, sf_dir).select(
        listing_id().alias("listing_id"), *[c.alias(n) for n, c in {**_common(), **texts, **other}.items()])


@cache
def rules():
    return default_rules(SCOPE)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_listings(raw(spark, sf_dir), rules())


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_test_split(clean(spark, sf_dir), "listing_id", SEEDS)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and both targets with the side of the split."""
    rows = split(spark, sf_dir)
    features = feature_select_columns(rows, SCOPE, keep=("listing_id", "split", TARGET))
    return with_price_segment(features, train_threshold(rows))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a valuation request; some have an unknown power or an unseen brand, or lie outside the bounds."""
    brand = F.when(F.col("p_partkey") % 97 == 5, F.lit("Nobody")).otherwise(F.col("p_brand"))
    decade = F.floor(F.col("p_size") / F.lit(10))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("request_id"),
        brand.alias("brand"),
        F.concat_ws(" ", brand, "p_name").alias("model"),
        fuel().alias("fuel_type"),
        F.when(F.col("p_size") > 25, F.lit("A")).otherwise(F.lit("R")).alias("transmission_type"),
        (decade + 1995).cast("int").alias("min_year"),
        (decade + 1997).cast("int").alias("max_year"),
        F.when(F.col("p_type") != "STANDARD", F.col("p_size").cast("double")).alias("power_ps"),
        F.floor((F.col("p_retailprice") - 900) / 2).cast("double").alias("mileage_in_km"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request beside the next one."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pair_id"), F.col("p_partkey").alias("request_a"),
        (F.col("p_partkey") + 1).alias("request_b"))


def group_mean_scores(rows: DataFrame) -> DataFrame:
    """A predictor that SQL can follow: training averages per model, else per brand, else of all.

    `rows` are labelled; adds the predicted price, the share of HIGH as score and the predicted segment.
    """
    train = rows.filter(F.col("split") == "train")
    means = lambda keys, name: train.groupBy(*keys).agg(
        F.avg(TARGET).alias(f"price_{name}"), F.avg(SEGMENT).alias(f"high_{name}"))
    overall = train.agg(F.struct(F.avg(TARGET).alias("price"), F.avg(SEGMENT).alias("high"))).scalar()
    found = rows.join(means(["model"], "m"), "model", "left").join(means(["brand"], "b"), "brand", "left")
    return found.withColumns({
        "price": F.coalesce("price_m", "price_b", overall["price"]),
        "score": F.coalesce("high_m", "high_b", overall["high"]),
    }).select("listing_id", "split", TARGET, SEGMENT, "price", "score",
              F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("segment"))


def classified(rows: DataFrame) -> DataFrame:
    return group_mean_scores(rows).select(
        "listing_id", "split", F.col(SEGMENT).alias("label"), F.col("segment").alias("prediction"), "score")


def priced(rows: DataFrame) -> DataFrame:
    return group_mean_scores(rows).select(
        "listing_id", "split", F.col(TARGET).alias("label"), F.col("price").alias("prediction"))


def scored_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests scored by the same averages: price, segment and confidence."""
    rows = labelled(spark, sf_dir)
    train = rows.filter(F.col("split") == "train")
    by_model = train.groupBy("model").agg(F.avg(TARGET).alias("price_m"), F.avg(SEGMENT).alias("high_m"))
    by_brand = train.groupBy("brand").agg(F.avg(TARGET).alias("price_b"), F.avg(SEGMENT).alias("high_b"))
    overall = train.agg(F.struct(F.avg(TARGET).alias("price"), F.avg(SEGMENT).alias("high"))).scalar()
    high = F.coalesce("high_m", "high_b", overall["high"])
    return (
        requests(spark, sf_dir).join(by_model, "model", "left").join(by_brand, "brand", "left")
        .select("request_id", F.coalesce("price_m", "price_b", overall["price"]).alias("price"),
                F.when(high >= 0.5, F.lit("HIGH")).otherwise(F.lit("LOW")).alias("segment"),
                F.greatest(high, 1 - high).alias("confidence"))
    )
