"""One query per operator, each over the whole test tables."""

from __future__ import annotations

import json
import math
from functools import cache, reduce

from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from forecourt.config import CATEGORICAL, FEATURES, MEASURES, NUMERIC, SEGMENT, TARGET
from forecourt.functions.columns import title_label
from forecourt.operators import arriving, cleaning, features, metrics, profiling, splitting
from forecourt.operators.compare import compare_pairs
from forecourt.operators.explain import explain_listing
from forecourt.operators.lookups import brand_context, brand_model_options, fuel_options, impute_power, power_medians
from forecourt.operators.similar import display_labels, similar_listings
from forecourt.plans import encode, ladder, reports, scoring, search
from forecourt.plans.impute import MissingValues
from forecourt.plans.registry import Registry
from forecourt.plans.select import BestScores, feature_scores
from forecourt.sources import readers, sinks
from forecourt.sources.storage import scratch, written
from forecourt.streaming.score_stream import read_requests, score_stream

SCOPE, SEEDS = t.SCOPE, t.SEEDS


def rounded(df: DataFrame, *columns: str, decimals: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, decimals) for c in columns})


# Sources and sinks


def scan_listings(spark, d):
    path = scratch(spark, "raw-csv")
    t.raw_text(spark, d).write.option("header", True).option("escape", '"').csv(path)
    columns = ("listing_id", *t.raw_text(spark, d).columns[1:])
    return readers.scan_listings(spark, path, columns).withColumnRenamed("Unnamed: 0", "row_label")


def _broken_files(spark, d) -> str:
    """The raw listings in two sets of files: one with its columns in another order and one more, one with line breaks inside quotes.
    Records of every eleventh order have two fields too many, those of every thirteenth none for the last column."""
    path = scratch(spark, "broken-csv")
    files = max(1, t.table(spark, d, "lineitem").count() // 200_000)
    rows = t.joined(spark, d).select("l_orderkey", t.listing_id().alias("listing_id"), *[F.col(c).alias(n) for n, c in (
        ("brand", "p_brand"), ("model", "p_name"), ("fuel_type", "p_type"), ("offer_description", "l_returnflag"))], F.lit("?").alias("unused"))
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))
    of_order = lambda n, text: F.when(F.col("l_orderkey") % n == 0, text).otherwise(F.lit(""))
    for name, columns, odd in (("reordered", ("fuel_type", "model", "listing_id", "unused", "brand", "offer_description"), 0),
                               ("second-lines", ("listing_id", "offer_description", "model", "brand", "fuel_type"), 1)):
        some = rows.where(F.col("l_orderkey") % 2 == odd)
        if odd:
            some = some.withColumn("offer_description", F.concat("offer_description", F.lit("\n, second line")))
        last = F.when(F.col("l_orderkey") % 13 != 0, F.concat(F.lit(","), quoted(columns[-1]))).otherwise(F.lit(""))
        lines = some.select(F.concat(F.concat_ws(",", *map(quoted, columns[:-1])), last, of_order(11, F.lit(",too,many"))).alias("value"))
        # Files of some 100,000 records, each with its header first.
        header = spark.range(files).select(F.lit(",".join(columns)).alias("value"), F.col("id").alias("part"), F.lit(0).alias("line"))
        header.union(lines.select("value", F.pmod(F.xxhash64("value"), F.lit(files)).alias("part"), F.lit(1).alias("line"))) \
            .repartition(files, "part").sortWithinPartitions("part", "line").drop("line").write.partitionBy("part").text(f"{path}/{name}")
    return f"{path}/*/part=*"


LISTED = ("listing_id", "brand", "model", "fuel_type", "offer_description")


def scan_by_name(spark, d):
    return readers.scan_records(spark, _broken_files(spark, d), LISTED).kept


def scan_quarantine(spark, d):
    return readers.scan_audit(readers.scan_records(spark, _broken_files(spark, d), LISTED))


def coerce_numeric(spark, d):
    return readers.coerce_numeric(t.raw_text(spark, d)).select("listing_id", *readers.NUMBERS)


def write_verified(spark, d):
    return sinks.write_verified(t.clean(spark, d), scratch(spark, "clean"), "csv")


def write_splits(spark, d):
    return sinks.write_splits(t.labelled(spark, d), scratch(spark, "splits"))


def cleaning_report(spark, d):
    report = reports.cleaning_report(t.raw(spark, d), t.rules(), SCOPE)
    back = sinks.write_json(report, scratch(spark, "cleaning-report"))
    return back.select(
        "raw_rows", "clean_rows", F.array_join("final_columns", ",").alias("final_columns"),
        F.size("cleaning_steps").alias("steps"),
        F.expr("aggregate(cleaning_steps.removed, 0L, (a, x) -> a + x)").alias("removed"),
        F.round("pct_retained", 2).alias("pct_retained"))


def split_report(spark, d):
    rows = t.split(spark, d)
    report = reports.split_report(t.labelled(spark, d), features.train_threshold(rows), SEEDS, SCOPE)
    back = sinks.write_json(report, scratch(spark, "split-report"))
    return back.select(
        "seed", "test_percent", "reference_year", F.round("price_segment_threshold", 6).alias("threshold"),
        F.col("balance")[0]["n"].alias("n_test"), F.col("balance")[1]["n"].alias("n_train"),
        "encoding.brand", "encoding.fuel_type", "encoding.transmission_type", "encoding.frequent_models",
        "encoding.rare_models", "encoding.features", F.size("checks").alias("checks"),
        F.size(F.expr("filter(checks, c -> c.passed)")).alias("checks_passed"))


def _boards(spark, d):
    """Leaderboard rows of the dummy and the group means."""
    rows = written(t.labelled(spark, d), "labelled")
    train = rows.filter("split = 'train'")
    dummy = ladder.dummy_classifier(train, rows).select("split", F.col(SEGMENT).alias("label"), "prediction", "score")
    return ladder.leaderboard([ladder.classifier_row(0, "dummy", dummy, 0.0),
                               ladder.classifier_row(1, "group mean", t.classified(rows), 0.0)])


def _reg_boards(spark, d):
    rows = written(t.labelled(spark, d), "labelled")
    dummy = ladder.dummy_regressor(rows.filter("split = 'train'"), rows).select(
        "split", F.col(TARGET).alias("label"), "prediction")
    return ladder.leaderboard([ladder.regressor_row(0, "dummy", dummy, 0.0),
                               ladder.regressor_row(1, "group mean", t.priced(rows), 0.0)])


def leaderboard(spark, d):
    return _boards(spark, d).drop("fit_seconds")


def leaderboard_sink(spark, d):
    return sinks.leaderboard_sink(_reg_boards(spark, d), scratch(spark, "leaderboard")).drop("fit_seconds")


def encoded(spark, d) -> ladder.Encoded:
    return ladder.encode(written(t.labelled(spark, d), "labelled"), SEEDS)


def valuer(spark, d) -> scoring.Valuer:
    """The tree rungs, with the threshold that the training rows have."""
    enc = encoded(spark, d)
    train = enc.side("train")
    threshold = spark.range(1).select(features.train_threshold(t.split(spark, d))).first()[0]
    return scoring.Valuer(ladder.complete(enc, ladder.timed_fit(ladder.tree_classifier(), train)[0]),
                          ladder.complete(enc, ladder.timed_fit(ladder.tree_regressor(), train)[0]), threshold, medians(spark, d))


def medians(spark, d, listings: DataFrame | None = None) -> DataFrame:
    return written(power_medians(t.clean(spark, d) if listings is None else listings), "medians")


def _powered(spark, d, listings: DataFrame | None = None) -> DataFrame:
    return features.with_midpoint(impute_power(t.requests(spark, d), medians(spark, d, listings), SCOPE).drop("power_from"))


def _allowed(spark, d) -> DataFrame:
    """Requests within the bounds; some do not know their power."""
    valid, _ = features.split_requests(t.requests(spark, d), SCOPE)
    return written(valid, "requests")


def model_save(spark, d):
    """Saves, loads and scores with both; counts requests on which they differ."""
    fitted, rows = valuer(spark, d), _allowed(spark, d)
    loaded = scoring.model_load(spark, scoring.model_save(fitted, spark, scratch(spark, "models")))
    both = [scoring.score_listings(rows, v, SCOPE).select("request_id", F.struct("price", "p_high").alias(n))
            for v, n in ((fitted, "before"), (loaded, "after"))]
    return both[0].join(both[1], "request_id").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("before") != F.col("after")).alias("different"))


def model_load(spark, d):
    loaded = scoring.model_load(spark, scoring.model_save(valuer(spark, d), spark, scratch(spark, "models")))
    return spark.range(1).select(F.round(F.lit(loaded.threshold), 6).alias("threshold"),
                                 F.lit(len(loaded.classifier.stages)).alias("classifier_stages"),
                                 F.lit(len(loaded.regressor.stages)).alias("regressor_stages"))


@cache
def _runs_folder(session: str, d: str) -> str:
    return scratch(SparkSession.active(), "registry")


def registry(spark, d) -> Registry:
    """The runs over a table's training rows in this session: a fit that one query has made is not made again."""
    return Registry(spark, _runs_folder(spark.sparkContext.applicationId, d))


def model_report(spark, d):
    """All rungs of both ladders and both random searches at their stated settings, from the registry alone."""
    runs, enc = registry(spark, d), encoded(spark, d)
    ladder.classification_ladder(enc, registry=runs)
    ladder.regression_ladder(enc, registry=runs)
    _random(spark, d, True)
    _random(spark, d, False)
    threshold = spark.range(1).select(features.train_threshold(t.split(spark, d))).first()[0]
    report = reports.model_report(runs, enc.preprocessing, threshold, SEEDS)
    back = sinks.write_json(report, scratch(spark, "model-report"))
    setting = lambda rungs, model, name: F.get_json_object(
        F.filter(rungs, lambda r: r["model"] == model)[0]["settings"], f"$.{name}")
    both = F.filter("searches", lambda x: x["run"].startswith("random_search"))
    best = lambda rungs, metric: F.array_max(F.transform(rungs, lambda r: r["metrics"][metric]))
    of = lambda rungs, model, metric: F.filter(rungs, lambda r: r["model"] == F.col(model))[0]["metrics"][metric]
    names = lambda rungs: F.array_join(F.transform(rungs, lambda r: r["model"]), ",")
    total = lambda field: F.aggregate(F.transform(both, lambda x: x[field]), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return back.select(
        "seed", "features_before_selection", "features_removed", F.round("price_segment_threshold", 6).alias("threshold"),
        names(F.col("classification")).alias("classifiers"), names(F.col("regression")).alias("regressors"),
        setting("classification", "logistic", "c").cast("double").alias("logistic_c"),
        setting("classification", "tree", "maxDepth").cast("int").alias("tree_depth"),
        setting("classification", "boosted", "maxIter").cast("int").alias("boosted_rounds"),
        setting("regression", "ridge", "alpha").cast("double").alias("ridge_alpha"),
        setting("regression", "boosted", "maxDepth").cast("int").alias("boosted_depth"),
        (of("classification", "best_classifier", "f1_macro") == best("classification", "f1_macro")).alias("best_classifier_is_extreme"),
        (of("regression", "best_regressor", "r2") == best("regression", "r2")).alias("best_regressor_is_extreme"),
        F.size(both).alias("searches"), total("draws").alias("draws"), total("fits").alias("fits"),
        F.forall(both, lambda x: F.get_json_object(x["best_settings"], "$.maxIter").cast("int").between(*search.ROUNDS)
                 & F.get_json_object(x["best_settings"], "$.maxDepth").cast("int").between(*search.DEPTHS)).alias("best_within_ranges"))


def leaderboards(spark, d):
    """Every rung of both ladders with its test metrics, as the registry has them."""
    runs, enc = registry(spark, d), encoded(spark, d)
    ladder.classification_ladder(enc, registry=runs)
    ladder.regression_ladder(enc, registry=runs)
    return runs.of(ladder.LADDER).select("task", "model", "settings", F.explode("metrics").alias("metric", "value"), "seconds")


def options(spark, d):
    return brand_model_options(t.clean(spark, d)).select(
        "brand", F.size("models").alias("n"), F.array_join("models", "|").alias("models"))


def listing_sample(spark, d):
    # A sampling operator: its limit is the feature. It draws from all clean rows.
    return splitting.sample_rows(t.clean(spark, d), 1000, "listing_id", SEEDS).select("listing_id", "brand", "model",
                                                                                     "year", TARGET)


# Projections and filters


def drop_columns(spark, d):
    return cleaning.drop_columns(t.raw(spark, d))


def clean_step(spark, d):
    # Every rule is a pass of its own: over the columns that rules name, worked out once.
    rows = written(t.raw(spark, d).select(*MEASURES, "fuel_type", "transmission_type"), "raw")
    steps = [cleaning.clean_step(rows, r) for r in t.rules()]
    return rounded(reduce(DataFrame.unionByName, steps).drop("reason"), "kept_pct")


def _kept(*rules):
    return lambda spark, d: cleaning.remove(t.raw(spark, d), *rules).select(
        "listing_id", *CATEGORICAL[:1], "fuel_type", "transmission_type", *MEASURES)


def cleaning_audit(spark, d):
    return rounded(cleaning.cleaning_audit(t.raw(spark, d), t.rules()), "kept_pct")


def car_age(spark, d):
    return features.with_car_age(t.clean(spark, d), SCOPE).select("listing_id", "car_age")


def mileage_per_year(spark, d):
    return rounded(features.with_mileage_per_year(features.with_car_age(t.clean(spark, d), SCOPE)).select(
        "listing_id", "mileage_per_year"), "mileage_per_year")


def feature_select_columns(spark, d):
    return rounded(features.feature_select_columns(t.clean(spark, d), SCOPE, ("listing_id",)), "mileage_per_year")


def price_segment(spark, d):
    return t.labelled(spark, d).select("listing_id", "split", TARGET, SEGMENT)


def scope_flag(spark, d):
    priced = t.scored_requests(spark, d).select("request_id", (F.col("price") * 2).alias("price"))
    return rounded(features.scope_flag(priced, "price", SCOPE), "price", decimals=7)


def input_bounds(spark, d):
    return features.input_bounds(t.requests(spark, d), SCOPE).select("request_id", "rejected_for", "valid")


def year_midpoint(spark, d):
    return features.with_midpoint(t.requests(spark, d)).select("request_id", "min_year", "max_year", "year")


def build_input_row(spark, d):
    return rounded(features.build_input_row(t.requests(spark, d), SCOPE), "mileage_per_year")


def labels(spark, d):
    rows = t.clean(spark, d).withColumns({"brand": F.lower("brand"), "fuel_type": title_label(F.col("fuel_type"))})
    shown = display_labels(rows)
    # Names as a check tool likes them; the operator itself shows 'Mileage (km)' and the like.
    return shown.toDF("brand", "model", "year", "mileage", "fuel", "transmission", "power", "price")


# Lookups


def impute(spark, d):
    return impute_power(t.requests(spark, d), medians(spark, d), SCOPE).select("request_id", "power_ps", "power_from")


def fuels(spark, d):
    return fuel_options(t.requests(spark, d), t.clean(spark, d), SCOPE).select(
        "request_id", F.array_join("fuels", "|").alias("fuels"))


def similar(spark, d):
    sample = written(t.clean(spark, d), "clean")
    asked = written(_powered(spark, d, sample), "requests")
    return rounded(similar_listings(asked, sample).select(
        "request_id", "rank", "score", "matched_on", "listing_id", "model", "year", "power_ps", "mileage_in_km",
        TARGET), "score")


def explain(spark, d):
    sample = written(t.clean(spark, d), "clean")
    return explain_listing(_powered(spark, d, sample), sample, SCOPE).select(
        "request_id", F.array_join("reasons", ",").alias("reasons"), F.array_join("sentences", " | ").alias("sentences"))


def compare(spark, d):
    scored = written(t.scored_requests(spark, d), "scored")
    return rounded(compare_pairs(t.pairs(spark, d), scored), "price_a", "price_b", "difference", "difference_pct",
                   "confidence_a", "confidence_b", decimals=7)


def context(spark, d):
    return rounded(brand_context(t.clean(spark, d)), "brand_median", "overall_median")


# Profiles


def null_profile(spark, d):
    return rounded(profiling.null_profile(t.raw(spark, d)), "missing_pct")


def duplicate_count(spark, d):
    return profiling.duplicate_count(t.raw(spark, d))


def numeric_summary(spark, d):
    return rounded(profiling.numeric_summary(t.clean(spark, d)), "mean", "std", "q25", "q50", "q75")


def arriving_profile(spark, d):
    """The raw listings as four loads, each profiled once; sketches beside the rows that they stand for."""
    rows, path = written(t.raw(spark, d), "raw"), scratch(spark, "loads")
    columns = [*MEASURES, *CATEGORICAL]
    for k in range(4):
        arriving.add_load(rows.where(F.conv(F.substring("listing_id", 1, 1), 16, 10) % 4 == k), f"load{k}", path, columns)
    merged = written(arriving.merged_profile(arriving.loads(spark, path)), "profile")
    # The share of values below a quantile, and of values up to it, enclose the share that was asked for.
    within = profiling.long_form(rows, MEASURES).where("value IS NOT NULL").join(merged.select("column_name", "quantiles"), "column_name") \
        .groupBy("column_name").agg(F.array(*[
            (F.avg((F.col("value") < F.col("quantiles")[i]).cast("int")) - arriving.RANK_ERROR <= share)
            & (F.avg((F.col("value") <= F.col("quantiles")[i]).cast("int")) + arriving.RANK_ERROR >= share)
            for i, share in enumerate((0.25, 0.5, 0.75))]).alias("within"))
    exact = rows.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("exact")) for c in columns]).alias("e")).select(F.inline("e"))
    return rounded(merged.join(within, "column_name", "left").join(exact, "column_name").select(
        "column_name", "loads", "rows", "missing", "n", "mean", "std", "min", "max",
        F.coalesce(F.forall("within", lambda w: w), F.lit(True)).alias("quantiles_within"),
        (F.abs(F.col("different") - F.col("exact")) <= arriving.DISTINCT_ERROR * F.col("exact")).alias("different_within")), "mean", "std")


FILLED = ("year", "power_ps", "mileage_in_km")


def imputation(spark, d):
    """Missing values of the raw listings filled with what the training rows have."""
    rows = splitting.train_test_split(written(t.raw(spark, d), "raw"), "listing_id", SEEDS)
    stage = MissingValues(inputCols=list(FILLED), textCols=["fuel_type", "transmission_type"])
    filled = stage.fit(rows.where("split = 'train'")).transform(rows)
    return filled.select("listing_id", "split", *FILLED, "fuel_type", "transmission_type")


def f_scores(spark, d):
    """F scores of the encoded features against price and segment, and which of all are among the best twenty."""
    enc = encoded(spark, d)
    train = enc.side("train")
    kept = [(n, source) for n, source, k in encode.feature_names(enc.preprocessing) if k]
    names = spark.createDataFrame([(i, n, source) for i, (n, source) in enumerate(kept)], "position int, feature string, source string")
    parts = []
    for task, label in (("regression", TARGET), ("classification", SEGMENT)):
        scores = written(feature_scores(train, label), "scores")
        best = BestScores(k=20, labelCol=label).fit(train).getIndices()
        lowest = scores.where(F.col("position").isin(best)).agg(F.min("score")).scalar()
        parts.append(scores.join(names, "position").select(
            F.lit(task).alias("task"), "feature", "source", F.round("score", 2).alias("score"),
            (F.col("position").isin(best) == (F.col("score") >= lowest)).alias("chosen_by_score")))
    return parts[0].unionByName(parts[1]).where(F.col("source") != "model").drop("source")


def value_range(spark, d):
    return profiling.value_range(t.raw(spark, d))


def distinct_counts(spark, d):
    return profiling.distinct_counts(t.clean(spark, d), ["brand", "model", "fuel_type", "transmission_type", "year"])


def category_counts(spark, d):
    return profiling.category_counts(t.raw(spark, d), "fuel_type")


def top_k(spark, d):
    return profiling.category_counts(t.clean(spark, d), "model", 20)


def category_share(spark, d):
    return profiling.category_share(t.clean(spark, d), "fuel_type", 6)


def year_counts(spark, d):
    rows = [profiling.year_counts(x).withColumn("stage", F.lit(n))
            for x, n in ((t.raw(spark, d), "raw"), (t.clean(spark, d), "clean"))]
    return rows[0].unionByName(rows[1])


HISTOGRAMS = {
    "histogram_price_raw": (t.raw, lambda: F.col(TARGET), 100),
    "histogram_price_clean": (t.clean, lambda: F.col(TARGET), 80),
    "histogram_price_train": (lambda spark, d: t.split(spark, d).filter("split = 'train'"), lambda: F.col(TARGET), 80),
    "histogram_log_price_raw": (t.raw, lambda: F.log1p(TARGET), 100),
    "histogram_log_price_clean": (t.clean, lambda: F.log1p(TARGET), 80),
    "histogram_mileage": (t.clean, lambda: F.col("mileage_in_km") / 1000, 80),
    "histogram_power": (t.clean, lambda: F.col("power_ps"), 60),
}


def _histogram(name):
    rows, value, bins = HISTOGRAMS[name]
    return lambda spark, d: rounded(profiling.histogram(rows(spark, d), value(), bins), "lower", "upper",
                                     decimals=9)


def log_price(spark, d):
    return rounded(profiling.log_price(t.clean(spark, d)).select("listing_id", "log_price"), "log_price")


def skewness(spark, d):
    return rounded(profiling.skewness(t.raw(spark, d), t.clean(spark, d)), "skewness")


def group_median(spark, d):
    return rounded(profiling.group_median(t.clean(spark, d)), "median_price")


def correlation_matrix(spark, d):
    return rounded(profiling.correlation_matrix(t.clean(spark, d)), "r")


def quantiles(spark, d):
    return profiling.quantiles(t.clean(spark, d), "year", (0.25, 0.5))


def train_threshold(spark, d):
    return spark.range(1).select(F.round(features.train_threshold(t.split(spark, d)), 6).alias("threshold"))


def class_balance(spark, d):
    return rounded(features.class_balance(t.labelled(spark, d)), "share_low", "share_high")


def feature_summary(spark, d):
    rows = features.feature_select_columns(t.clean(spark, d), SCOPE)
    return rounded(profiling.feature_summary(rows), "mean_age", "min_km_per_year", "max_km_per_year",
                   "median_km_per_year")


def leakage_checks(spark, d):
    """The threshold and the means of a saved and loaded model against the rows."""
    rows = written(t.labelled(spark, d), "labelled")
    fitted = valuer(spark, d)
    stored = scoring.model_load(spark, scoring.model_save(fitted, spark, scratch(spark, "models")))
    means = encode.scaler_means(stored.classifier)
    return rounded(features.leakage_checks(rows, F.lit(stored.threshold), means), "expected", "actual")


# Split, encoding, models, metrics


def train_test_split(spark, d):
    return t.split(spark, d).select("listing_id", "split")


def stratified_split(spark, d):
    rows = t.labelled(spark, d).drop("split")
    return splitting.stratified_split(rows, [SEGMENT], "listing_id", SEEDS).select("listing_id", SEGMENT, "split")


def sample_rows(spark, d):
    # The 10,000 points of the price by mileage plot.
    return splitting.sample_rows(t.clean(spark, d), 10000, "listing_id", SEEDS).select(
        "listing_id", "mileage_in_km", TARGET, "year")


def fold_assign(spark, d):
    train = t.labelled(spark, d).filter("split = 'train'")
    return splitting.fold_assign(train, "listing_id", [SEGMENT], SEEDS).select("listing_id", SEGMENT, "fold")


def min_frequency_bucket(spark, d):
    rows = t.labelled(spark, d)
    return encode.min_frequency_bucket(rows.filter("split = 'train'"), rows).select("listing_id", "model_level")


def _feature_sums(spark, d, wanted, model_rows=None):
    """Sum of every encoded feature over the test rows, by feature name."""
    enc = encoded(spark, d)
    kept = [n for n in encode.feature_names(enc.preprocessing) if n[2]]
    names = F.array(*[F.lit(n) for n, source, _ in kept])
    sources = F.array(*[F.lit(source) for _, source, _ in kept])
    sums = enc.side("test").select(vector_to_array(Summarizer.sum(F.col("features"))).alias("sums"))
    return sums.select(F.inline(F.arrays_zip(names.alias("feature"), sources.alias("source"),
                                             F.col("sums").alias("total")))).filter(F.col("source").isin(*wanted))


def onehot_ignore(spark, d):
    return rounded(_feature_sums(spark, d, encode.PLAIN), "total", decimals=3)


def preprocess(spark, d):
    return rounded(_feature_sums(spark, d, FEATURES), "total", decimals=3)


def standard_scale(spark, d):
    rows = t.labelled(spark, d)
    scaled = [f"{c}_scaled" for c in NUMERIC]
    return rounded(encode.standard_scale(rows.filter("split = 'train'"), rows).select("listing_id", *scaled), *scaled)


def variance_threshold(spark, d):
    kept = [k for _, _, k in encode.feature_names(encoded(spark, d).preprocessing)]
    return spark.range(1).select(F.lit(len(kept)).alias("features_before"), F.lit(sum(kept)).alias("features_after"))


def feature_inventory(spark, d):
    return encode.feature_inventory(spark, encoded(spark, d).preprocessing)


def dummy_classifier(spark, d):
    rows = t.labelled(spark, d)
    out = ladder.dummy_classifier(rows.filter("split = 'train'"), rows)
    return out.filter("split = 'test'").select("listing_id", "prediction", "score")


def dummy_regressor(spark, d):
    rows = t.labelled(spark, d)
    out = ladder.dummy_regressor(rows.filter("split = 'train'"), rows)
    return rounded(out.filter("split = 'test'").select("listing_id", "prediction"), "prediction", decimals=7)


# The fitted rungs have no SQL of their own. Each is fitted at its full settings, and what must hold of the fit is
# worked out from the rows: SQL knows the rows and that it holds.


def _sides(rows) -> DataFrame:
    return rows.agg(F.count_if(F.col("split") == "train").alias("train_rows"), F.count_if(F.col("split") == "test").alias("test_rows"))


def _gradient(scored, error, weights, penalty, rows: float) -> float:
    """The largest entry of the objective's gradient at the fit: mean of error times feature, and the penalty's part.

    Only the values that a vector stores are exploded, some ten of a sparse one; the others add nothing to a sum."""
    vector = F.unwrap_udt(F.col("features"))
    places = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    sums = scored.select(error.alias("e"), F.inline(F.arrays_zip(places.alias("j"), vector["values"].alias("x")))) \
        .groupBy("j").agg(F.sum(F.col("e") * F.col("x")).alias("g")).collect()
    along = {r["j"]: r["g"] for r in sums}
    return max(abs(along.get(j, 0.0) + penalty * w) / rows for j, w in enumerate(weights))


def logistic_ladder(spark, d):
    """C = 10: the summed loss and the penalty have no slope left."""
    enc = encoded(spark, d)
    train = enc.side("train")
    fitted = ladder.RidgeLogistic(c=10.0).fit(train)
    error = vector_to_array("probability")[1] - F.col(SEGMENT)
    slope = _gradient(fitted.transform(train), error, fitted.coefficients.toArray(), 1 / 10.0, train.count())
    auc = metrics.roc_auc(ladder.scored_rows(fitted, enc.side("test"), SEGMENT)).first()["auc"]
    return _sides(enc.rows).select(F.lit("logistic").alias("model"), "*", F.lit(slope < 1e-3).alias("no_slope"),
                                   F.lit(0.0 <= auc <= 1.0).alias("auc_is_share"))


def ridge_ladder(spark, d):
    """alpha = 0.1: the squares and the penalty have no slope left, against the spread of prices."""
    enc = encoded(spark, d)
    train = enc.side("train")
    fitted = ladder.Ridge(alpha=0.1).fit(train)
    slope = _gradient(fitted.transform(train), F.col("prediction") - F.col(TARGET), fitted.coefficients.toArray(), 0.1, train.count())
    spread = train.agg(F.stddev_pop(TARGET)).first()[0]
    return _sides(enc.rows).select(F.lit("ridge").alias("model"), "*", F.lit(slope < 1e-4 * spread).alias("no_slope"))


def _tree(estimator, label, name):
    def query(spark, d):
        """Depth 15: every leaf predicts what its training rows have, the mean or the share of HIGH."""
        enc = encoded(spark, d)
        fitted = estimator().setLeafCol("leaf").fit(enc.side("train"))
        rows = fitted.transform(enc.side("train"))
        said = vector_to_array("probability")[1] if "probability" in rows.columns else F.col("prediction")
        leaves = rows.groupBy("leaf").agg(F.avg(F.col(label).cast("double")).alias("mean"), F.min(said).alias("low"), F.max(said).alias("high"))
        near = lambda c: F.abs(F.col(c) - F.col("mean")) <= 1e-9 * F.greatest(F.lit(1.0), F.abs("mean"))
        return leaves.agg(F.count_if(~(near("low") & near("high"))).alias("wrong_leaves"), (F.count("*") > 1).alias("split")) \
            .join(_sides(enc.rows)).select(F.lit(name).alias("model"), "train_rows", "test_rows", "wrong_leaves", "split")

    return query


def _boosted(estimator, label, name):
    task = "regression" if label == TARGET else "classification"

    def query(spark, d):
        """271 rounds of depth 7: the loss of the training rows after the last round is that of the rows' own predictions,
        below that after the first round and below that of the dummy rung."""
        enc = encoded(spark, d)
        train = enc.side("train")
        fitted, _ = ladder.rung("boosted", estimator(), enc, task, registry(spark, d))
        losses = fitted.evaluateEachIteration(train, "squared") if label == TARGET else fitted.evaluateEachIteration(train)
        rows, y = fitted.transform(train), F.col(label).cast("double")
        # Boosting learns -1 and 1; the margin is what its raw prediction has for 1.
        sign = 2 * y - 1
        margin = vector_to_array("rawPrediction")[1] if label == SEGMENT else F.col("prediction")
        loss = 2 * F.log1p(F.exp(-2 * sign * margin)) if label == SEGMENT else F.pow(y - margin, 2)
        own, share, spread = rows.agg(F.avg(loss), F.avg(y), F.var_pop(y)).first()
        dummy = spread if label == TARGET else 2 * math.log(2) if share in (0, 1) else -2 * (share * math.log(share) + (1 - share) * math.log(1 - share))
        return _sides(enc.rows).select(
            F.lit(name).alias("model"), "*", F.lit(fitted.getNumTrees).alias("rounds"), F.lit(max(t.depth for t in fitted.trees)).alias("depth"),
            F.lit(losses[-1] < losses[0]).alias("loss_falls"), F.lit(abs(losses[-1] - own) <= 1e-6 * max(1.0, own)).alias("loss_is_the_rows"),
            F.lit(own < dummy).alias("below_dummy"))

    return query


#: Fits of a search that run at a time; each has few partitions here.
TOGETHER = 6


def _random(spark, d, classify: bool) -> search.Searched:
    train = written(t.labelled(spark, d).filter("split = 'train'"), "train")
    return search.random_search(train, classify, registry(spark, d), seeds=SEEDS, parallelism=TOGETHER)


def _random_search(classify: bool):
    def query(spark, d):
        """Six draws of 200 to 399 rounds and a depth of 5 to 8 in three folds, and the best one on all training rows."""
        found = _random(spark, d, classify)
        n = lambda name: F.get_json_object("settings", f"$.{name}")
        ranges = found.table().agg(
            F.bool_and(n("maxIter").cast("int").between(*search.ROUNDS) & n("maxDepth").cast("int").between(*search.DEPTHS)
                       & n("stepSize").cast("double").between(*search.RATES) & n("subsamplingRate").cast("double").between(*search.ROW_SHARES)
                       & n("featureSubsetStrategy").cast("double").between(*search.COLUMN_SHARES))).scalar()
        model = found.model().stages[0]
        best = found.best()
        return _searched(spark, d, found).withColumns({
            "within_ranges": ranges, "refitted_rounds": F.lit(model.getNumTrees == int(json.loads(best.settings)["maxIter"]))})

    return query


def _searched(spark, d, found: search.Searched) -> DataFrame:
    """Draws with the one that is best, and the rows that the folds share out."""
    metrics = [r.metric for r in found.table().collect()]
    extreme = (max if found.larger else min)(metrics)
    return found.table().groupBy().agg(
        F.count("*").alias("draws"), F.count_distinct("settings").alias("settings"), F.sum("fits").alias("fits"),
        F.bool_and(F.col("best") == (F.col("metric") == F.lit(extreme))).alias("best_is_extreme")) \
        .withColumn("folds", F.lit(found.folds)) \
        .withColumn("train_rows", t.labelled(spark, d).filter("split = 'train'").agg(F.count("*")).scalar())


def _grid(which):
    def query(spark, d):
        """The whole grid in three folds."""
        train = written(t.labelled(spark, d).filter("split = 'train'"), "train")
        return _searched(spark, d, search.grid_search(train, which, registry(spark, d), seeds=SEEDS, parallelism=TOGETHER))

    return query


def classification_metrics(spark, d):
    return rounded(metrics.classification_metrics(t.classified(t.labelled(spark, d)), ["split"]), "accuracy",
                   "precision", "recall", "f1_binary", "f1_macro")


def roc_auc(spark, d):
    return rounded(metrics.roc_auc(t.classified(t.labelled(spark, d)), ["split"]), "auc")


def roc_curve(spark, d):
    rows = t.classified(t.labelled(spark, d)).filter("split = 'test'")
    return rounded(metrics.roc_curve(rows), "threshold", "fpr", "tpr")


def confusion_matrix(spark, d):
    return metrics.confusion_matrix(t.classified(t.labelled(spark, d)).filter("split = 'test'"))


def regression_metrics(spark, d):
    return rounded(metrics.regression_metrics(t.priced(t.labelled(spark, d)), ["split"]), "r2", "mae", "rmse",
                   decimals=4)


def residuals(spark, d):
    rows = metrics.residuals(t.priced(t.labelled(spark, d)).filter("split = 'test'"))
    # The 5,000 points of the residual plot.
    return rounded(splitting.sample_rows(rows, 5000, "listing_id", SEEDS).select("listing_id", "label", "residual"),
                   "residual", decimals=7)


def _importance(estimator, name):
    task = "regression" if "regressor" in name else "classification"

    def query(spark, d):
        """Importances of the boosted rung at full settings: of known features, none negative, one in all."""
        enc = encoded(spark, d)
        names = encode.feature_names(enc.preprocessing)
        kept = [n for n, _, keep in names if keep]
        fitted, _ = ladder.rung("boosted", estimator(), enc, task, registry(spark, d))
        table = ladder.feature_importance(spark, fitted, names, top=len(kept))
        known = encode.feature_inventory(spark, enc.preprocessing).select("feature", "kept")
        return table.join(known, "feature", "left").agg(
            F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("total"),
            F.count_if(F.col("importance") < 0).alias("negative"), F.count_if(~F.coalesce("kept", F.lit(False))).alias("unknown")) \
            .select(F.lit(name).alias("model"), "*")

    return query


def _top_features(estimator, task):
    def query(spark, d):
        """The 20 most important features of the boosted rung, by name."""
        enc = encoded(spark, d)
        fitted, _ = ladder.rung("boosted", estimator(), enc, task, registry(spark, d))
        return rounded(ladder.feature_importance(spark, fitted, encode.feature_names(enc.preprocessing)), "importance")

    return query


def best_model(spark, d):
    return metrics.best_model(_boards(spark, d), "f1_macro").unionByName(
        metrics.best_model(_reg_boards(spark, d), "r2").withColumnRenamed("r2", "f1_macro")).withColumnRenamed(
        "f1_macro", "metric")


def beats_baseline(spark, d):
    """Classifiers by F1, regressors by R2."""
    boards = ((_boards, "f1_macro"), (_reg_boards, "r2"))
    parts = [metrics.beats_baseline(written(board(spark, d), "board"), metric, "dummy").select(
        F.lit(metric).alias("metric"), "model", F.col(metric).alias("value"), "verdict") for board, metric in boards]
    return parts[0].unionByName(parts[1])


def overfit_gap(spark, d):
    boards = ((_boards, "f1_macro"), (_reg_boards, "r2"))
    parts = [metrics.overfit_gap(board(spark, d), f"train_{metric}", metric).select(
        F.lit(metric).alias("metric"), "model", F.col(f"train_{metric}").alias("train"), F.col(metric).alias("test"), "gap")
        for board, metric in boards]
    return rounded(parts[0].unionByName(parts[1]), "gap")


def score_listings(spark, d):
    return scoring.score_listings(_allowed(spark, d), valuer(spark, d), SCOPE)


def score_checks(spark, d):
    """What scored requests must have, whatever the model: SQL knows the ids and that nothing is wrong."""
    rows = score_listings(spark, d)
    return rows.select(
        "request_id", (F.abs(F.col("p_low") + F.col("p_high") - 1) < 1e-9).alias("sums_to_one"),
        (F.col("confidence") == F.greatest("p_low", "p_high")).alias("larger_share"),
        ((F.col("segment_name") == "HIGH") == (F.col("p_high") > F.col("p_low"))).alias("segment_agrees"),
        (F.col("outside_scope") == ((F.col("price") < SCOPE.price_min) | (F.col("price") > SCOPE.price_max))).alias("scope_agrees"),
        F.round("segment_threshold", 6).alias("segment_threshold"))


def _streamed(spark, d):
    """All requests through the stream with a saved model: scored ones, rejected ones, and the scores of a batch."""
    asked = written(t.requests(spark, d), "requests")
    fitted = scoring.model_load(spark, scoring.model_save(valuer(spark, d), spark, scratch(spark, "models")))
    arriving, out, rejects, log = (scratch(spark, n) for n in ("arriving", "streamed", "rejected", "stream-log"))
    asked.repartition(4).write.parquet(arriving)
    stream = read_requests(spark, arriving, asked.schema, files_per_trigger=2)
    for query in score_stream(stream, fitted, SCOPE, out, rejects, log, {"availableNow": True}):
        query.awaitTermination()
    batch = scoring.score_listings(features.split_requests(asked, SCOPE)[0], fitted, SCOPE)
    wrong = features.split_requests(asked, SCOPE)[1]
    return spark.read.schema(batch.schema).parquet(out), spark.read.schema(wrong.schema).parquet(rejects), batch


def stream_scores(spark, d):
    """Every allowed request scored on a stream, beside the price of the batch."""
    scored, _, batch = _streamed(spark, d)
    batch = batch.select("request_id", F.col("price").alias("batch_price"), F.col("p_high").alias("batch_high"))
    same = (F.col("price") == F.col("batch_price")) & (F.col("p_high") == F.col("batch_high"))
    return scored.join(batch, "request_id").select("request_id", same.alias("as_batch"))


def stream_rejects(spark, d):
    """Every rejected request of the stream with its reasons."""
    return _streamed(spark, d)[1].select("request_id", "rejected_for")


#: Queries whose fits take long: a driver that runs all of them leaves these to the end.
LONG = ("boosted_classifier", "boosted_regressor", "feature_importance", "feature_importance_regressor", "top_features",
        "top_features_regressor", "leaderboards", "random_search", "random_search_regressor", "model_report")


def queries() -> dict:
    plain = {f.__name__: f for f in (
        scan_listings, scan_by_name, scan_quarantine, coerce_numeric, write_verified, write_splits, cleaning_report, split_report, model_report,
        leaderboard_sink, model_save, model_load, listing_sample, drop_columns, clean_step, cleaning_audit, car_age,
        mileage_per_year, feature_select_columns, price_segment, scope_flag, input_bounds, year_midpoint,
        build_input_row, null_profile, duplicate_count, numeric_summary, arriving_profile, imputation, f_scores, value_range, distinct_counts,
        category_counts, category_share, year_counts, log_price, skewness, group_median, correlation_matrix,
        quantiles, train_threshold, class_balance, feature_summary, leakage_checks, train_test_split,
        stratified_split, sample_rows, fold_assign, min_frequency_bucket, onehot_ignore, standard_scale, preprocess,
        variance_threshold, feature_inventory, dummy_classifier, dummy_regressor, leaderboards, logistic_ladder, ridge_ladder,
        classification_metrics, roc_auc, roc_curve, confusion_matrix, regression_metrics, residuals,
        leaderboard, best_model, beats_baseline, overfit_gap, score_listings, score_checks, top_k,
    )}
    named = {
        "brand_model_options": options,
        "drop_null_required": _kept(*cleaning.missing_rules()),
        "valid_category": _kept(cleaning.fuel_rule(SCOPE)),
        "drop_unknown": _kept(cleaning.transmission_rule(SCOPE)),
        "year_floor": _kept(cleaning.year_rule(SCOPE)),
        "price_range": _kept(*cleaning.price_rules(SCOPE)),
        "power_range": _kept(cleaning.power_rule(SCOPE)),
        "mileage_rules": _kept(*cleaning.mileage_rules(SCOPE)),
        "clean_listings": t.clean,
        "display_labels": labels,
        "impute_power": impute,
        "fuel_options": fuels,
        "similar_listings": similar,
        "explain_listing": explain,
        "compare_pairs": compare,
        "brand_context": context,
        "score_stream": stream_scores,
        "score_stream_rejects": stream_rejects,
        **{name: _histogram(name) for name in HISTOGRAMS},
        "tree_classifier": _tree(ladder.tree_classifier, SEGMENT, "tree classifier"),
        "tree_regressor": _tree(ladder.tree_regressor, TARGET, "tree regressor"),
        "boosted_classifier": _boosted(ladder.boosted_classifier, SEGMENT, "boosted classifier"),
        "boosted_regressor": _boosted(ladder.boosted_regressor, TARGET, "boosted regressor"),
        "feature_importance": _importance(ladder.boosted_classifier, "boosted classifier"),
        "feature_importance_regressor": _importance(ladder.boosted_regressor, "boosted regressor"),
        "top_features": _top_features(ladder.boosted_classifier, "classification"),
        "top_features_regressor": _top_features(ladder.boosted_regressor, "regression"),
        "random_search": _random_search(True),
        "random_search_regressor": _random_search(False),
        "grid_search": _grid("ridge"),
        "grid_search_logistic": _grid("logistic"),
        "grid_search_tree_classifier": _grid("tree_classifier"),
        "grid_search_tree_regressor": _grid("tree_regressor"),
    }
    return {**plain, **named}
