"""Rule-based reasons for a price, compared with the medians of known listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.config import Scope
from forecourt.functions.columns import euro, title_label, whole
from forecourt.operators.lookups import brand_context, sample_medians


def explain_listing(requests: DataFrame, sample: DataFrame, scope: Scope, most: int = 5) -> DataFrame:
    """Adds `reasons` (codes) and `sentences`, at most five each, in the order of the rules.

    Requests need year, power, mileage, brand and fuel. The medians are scalars; the brand verdicts are
    one row per brand.
    """
    med = sample_medians(sample)
    joined = requests.join(brand_context(sample).drop("n"), "brand", "left")
    aged = joined.withColumns({
        "_age": F.lit(scope.reference_year) - F.col("year"),
        "_med_km": med["mileage_in_km"],
        "_med_age": F.lit(scope.reference_year) - med["year"],
        "_med_power": med["power_ps"],
    })
    km, age, power = F.col("mileage_in_km"), F.col("_age"), F.col("power_ps")
    say = lambda code, *text: F.struct(F.lit(code).alias("code"), F.concat(*text).alias("text"))
    txt = F.lit
    fuel = F.lower("fuel_type")
    label = title_label(F.col("brand"))
    medians = F.concat(txt("median "), euro(F.col("brand_median")), txt(" against "), euro(F.col("overall_median")))
    against = F.concat(whole(km), txt(" km against a median of "), whole(F.col("_med_km")), txt(" km"))
    years = F.concat(whole(age), txt(" years against a median of "), whole(F.col("_med_age")))
    horses = F.concat(whole(power), txt(" PS against a median of "), whole(F.col("_med_power")), txt(" PS"))
    rules = [
        F.when(km < F.col("_med_km") * 0.75, say("mileage_low", txt("Low mileage raises the price: "), against))
        .when(km > F.col("_med_km") * 1.25, say("mileage_high", txt("High mileage lowers the price: "), against))
        .otherwise(say("mileage_average", txt("Ordinary mileage: "), against)),
        F.when(age < F.col("_med_age") * 0.75, say("age_newer", txt("Newer than most: "), years))
        .when(age > F.col("_med_age") * 1.25, say("age_older", txt("Older than most: "), years))
        .otherwise(say("age_average", txt("Ordinary age: "), years)),
        F.when(power > F.col("_med_power") * 1.35, say("power_high", txt("Strong engine: "), horses))
        .when(power < F.col("_med_power") * 0.70, say("power_low", txt("Weak engine: "), horses)),
        F.when(F.col("standing") == "above", say("brand_above", label, txt(" sells above the market: "), medians))
        .when(F.col("standing") == "below", say("brand_below", label, txt(" sells below the market: "), medians)),
        F.when(fuel.contains("electric"), say("fuel_electric", txt("Electric cars tend to be dearer when new")))
        .when(fuel.contains("hybrid"), say("fuel_hybrid", txt("Hybrids tend to be in the middle or above"))),
    ]
    told = F.slice(F.array_compact(F.array(*rules)), 1, most)
    return aged.withColumn("_told", told).select(
        *requests.columns,
        F.transform("_told", lambda t: t["code"]).alias("reasons"),
        F.transform("_told", lambda t: t["text"]).alias("sentences"),
    )
