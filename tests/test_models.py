"""Encoding, models, search, persistence and streaming on a small table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.config import NUMERIC, SEGMENT, TARGET, Scope, Seeds
from forecourt.operators.features import leakage_checks, split_requests, train_threshold
from forecourt.operators.splitting import train_test_split
from forecourt.operators.lookups import power_medians
from forecourt.plans import encode, ladder, reports, scoring, search
from forecourt.plans.registry import Registry, settings_of
from forecourt.sources.sinks import leaderboard_sink, write_splits
from forecourt.sources.storage import scratch, written
from forecourt.streaming.score_stream import read_requests, score_stream

SEEDS = Seeds(min_model_rows=30)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(5)
    n, rows = 600, []
    for i in range(n):
        brand = str(rng.choice(["audi", "bmw", "opel"], p=[0.5, 0.3, 0.2]))
        model = f"{brand} {rng.choice(['one', 'two', 'rare1', 'rare2'], p=[0.5, 0.44, 0.04, 0.02])}"
        age, power, km = float(rng.integers(0, 20)), float(rng.integers(60, 300)), float(rng.integers(1, 200) * 1000)
        price = 20000 + 90 * power - 900 * age - 0.03 * km + {"audi": 3000, "bmw": 5000, "opel": 0}[brand] + rng.normal(0, 900)
        rows.append((f"{i:04d}", brand, model, str(rng.choice(["Petrol", "Diesel"])), "Manual" if i % 9 else None, age, power,
                     km, km / max(age, 1), float(price)))
    df = spark.createDataFrame(rows, "listing_id string, brand string, model string, fuel_type string, transmission_type "
                                     "string, car_age double, power_ps double, mileage_in_km double, mileage_per_year "
                                     "double, price_in_euro double").repartition(3)
    split = train_test_split(df, "listing_id", SEEDS)
    return written(split.withColumn(SEGMENT, F.when(F.col(TARGET) >= train_threshold(split), 1).otherwise(0)), "small")


@pytest.fixture(scope="module")
def encoded(labelled):
    return ladder.encode(labelled, SEEDS)


def test_encoder_levels(spark, labelled, encoded):
    train = labelled.filter("split = 'train'").toPandas()
    names = encode.feature_names(encoded.preprocessing)
    sizes = train.groupby("model").size()
    frequent = sorted(sizes[sizes >= 30].index)
    assert [n for n, source, _ in names if source == "model"] == [*[f"model_{m}" for m in frequent], "model_infrequent"]
    assert [n for n, source, _ in names if source == "transmission_type"] == ["transmission_type_Manual",
                                                                            "transmission_type_nan"]
    strange = labelled.limit(1).withColumns({"brand": F.lit("new"), "model": F.lit("new new"), "fuel_type": F.lit(None)
                                             .cast("string")})
    vector = encoded.preprocessing.transform(strange).first()["features"].toArray()
    on = {n for (n, _, _), v in zip(names, vector) if v == 1 and n not in NUMERIC}
    assert {n for n in on if not n.startswith("transmission")} == {"model_infrequent"}  # an unseen brand, fuel: zeros


def test_bucket_only_if_training_had_rare_models(spark, labelled):
    common = labelled.filter(~F.col("model").contains("rare"))
    fitted = encode.preprocess(common.filter("split = 'train'"), Seeds(min_model_rows=1))
    assert not any("infrequent" in n for n, _, _ in encode.feature_names(fitted))
    levels = encode.min_frequency_bucket(common.filter("split = 'train'"), common.withColumn("model", F.lit("new")),
                                         least=1)
    assert levels.filter("model_level IS NOT NULL").count() == 0


def test_scaler_and_leakage(labelled, encoded):
    train = labelled.filter("split = 'train'").toPandas()
    means = encode.scaler_means(encoded.preprocessing)
    for c in NUMERIC:
        assert means[c] == pytest.approx(train[c].mean(), rel=1e-12)
    assert leakage_checks(labelled, train_threshold(labelled), means).filter("not passed").count() == 0
    stage = next(x for x in encode.flat_stages(encoded.preprocessing) if isinstance(x, encode.PopulationScalerModel))
    assert stage.by_column()["power_ps"][1] == pytest.approx(train["power_ps"].std(ddof=0), rel=1e-12)


def test_constant_columns_go(labelled):
    flat = labelled.withColumn("fuel_type", F.lit("Petrol"))
    fitted = encode.preprocess(flat.filter("split = 'train'"), SEEDS)
    assert [n for n, _, kept in encode.feature_names(fitted) if not kept] == ["fuel_type_Petrol"]


def test_ridge_is_the_closed_form(encoded):
    rows = encoded.side("train").select("features", TARGET).collect()
    x, y = np.array([r[0].toArray() for r in rows]), np.array([r[1] for r in rows])
    fitted = ladder.Ridge(alpha=0.1).fit(encoded.side("train"))
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 0.1 * np.eye(x.shape[1]), xc.T @ yc)
    assert np.allclose(x @ fitted.coefficients.toArray() + fitted.intercept, x @ want + y.mean() - x.mean(0) @ want, atol=2)


def test_ladders(spark, encoded):
    small = ladder.Boosting(rounds=3, depth=3)
    cls, models = ladder.classification_ladder(encoded, ladder.classifiers(small, depth=5))
    reg, _ = ladder.regression_ladder(encoded, ladder.regressors(small, depth=5))
    cls_rows = {r["model"]: r for r in cls.collect()}
    assert list(cls.orderBy("position").toPandas()["model"]) == ["dummy", "logistic", "tree", "boosted"]
    assert all(cls_rows[m]["f1_macro"] > cls_rows["dummy"]["f1_macro"] for m in models)
    assert cls_rows["logistic"]["roc_auc"] > 0.9 and cls_rows["dummy"]["roc_auc"] == 0.5
    reg_rows = {r["model"]: r for r in reg.collect()}
    assert reg_rows["ridge"]["r2"] > 0.9 and abs(reg_rows["dummy"]["train_r2"]) < 1e-9
    back = leaderboard_sink(cls, scratch(spark, "board"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cls.collect()))
    top = ladder.feature_importance(spark, models["tree"], encode.feature_names(encoded.preprocessing), 5).collect()
    assert len(top) == 5 and top[0]["importance"] >= top[4]["importance"]


def test_searches(spark, labelled):
    train = labelled.filter("split = 'train'")
    runs = Registry(spark, scratch(spark, "runs"))
    found = search.grid_search(train, "ridge", runs, (0.1, 100000.0), SEEDS)
    table = found.table().orderBy("draw").collect()
    assert table[0]["best"] and not table[1]["best"] and table[0]["metric"] < table[1]["metric"]
    assert [r["fits"] for r in table] == [3, 3] and '"alpha": 0.1' in table[0]["settings"]
    # The fits of a fold are those of a fold whose encoding has seen its own rows only.
    place = search.encoded_folds(train, False, runs, SEEDS)[1]
    sides = {s: spark.read.parquet(f"{place}/{s}").count() for s in ("fit", "held")}
    assert sum(sides.values()) == train.count() and sides["fit"] > sides["held"]
    by_hand = ladder.Ridge(alpha=0.1).fit(spark.read.parquet(f"{place}/fit"))
    held = by_hand.transform(spark.read.parquet(f"{place}/held")).select("prediction", TARGET).toPandas()
    rmse = float(np.sqrt(((held.prediction - held[TARGET]) ** 2).mean()))
    assert runs.ended("grid_search_ridge")["regression", "Ridge", 0, 1].metrics["metric"] == pytest.approx(rmse, rel=1e-9)
    whole = search.encoded_folds(train, False, runs, SEEDS, folds=[search.ALL])[search.ALL]
    assert spark.read.parquet(f"{whole}/held").count() == 0
    assert found.model().transform(spark.read.parquet(f"{whole}/fit")).count() == train.count()
    estimator = ladder.boosted_classifier()
    maps = search.random_maps(estimator)
    assert len(maps) == 6 and maps == search.random_maps(estimator)
    assert all(200 <= m[estimator.maxIter] <= 399 and 5 <= m[estimator.maxDepth] <= 8 for m in maps)


def test_a_search_goes_on_where_it_stopped(spark, labelled, monkeypatch):
    train = labelled.filter("split = 'train'")
    runs = Registry(spark, scratch(spark, "runs"))
    fitted, fit = [], ladder.DecisionTreeRegressor.fit

    def counted(self, rows, params=None):
        depth = (params or {}).get(self.maxDepth, self.getMaxDepth())
        if len(fitted) == 4:
            raise RuntimeError("lost")
        fitted.append(depth)
        return fit(self, rows, params)

    monkeypatch.setattr(ladder.DecisionTreeRegressor, "fit", counted)
    with pytest.raises(RuntimeError, match="lost"):
        search.grid_search(train, "tree_regressor", runs, (2, 3), SEEDS, parallelism=1)
    assert runs.of("grid_search_tree_regressor").count() == 4
    fitted.clear()
    found = search.grid_search(train, "tree_regressor", runs, (2, 3), SEEDS, parallelism=1)
    assert len(fitted) == 3  # the two that were left, and the best one on all rows
    assert [r.fits for r in found.table().collect()] == [3, 3]
    fitted.clear()
    again = search.grid_search(train, "tree_regressor", runs, (2, 3), SEEDS)
    assert fitted == [] and again.best() == found.best()
    # Other settings under the same name are other fits.
    assert search.grid_search(train, "tree_regressor", runs, (2, 4), SEEDS, parallelism=1).table().count() == 2 and len(fitted) >= 3


def test_report_from_the_registry(spark, labelled, encoded):
    runs = Registry(spark, scratch(spark, "runs"))
    assert runs.rows().count() == 0
    small = ladder.Boosting(rounds=2, depth=2)
    cls, reg = ladder.classifiers(small, depth=3), ladder.regressors(small, depth=3)
    board, models = ladder.classification_ladder(encoded, cls, runs)
    ladder.regression_ladder(encoded, reg, runs)
    found = search.random_search(labelled.filter("split = 'train'"), False, runs, draws=2, seeds=SEEDS, rounds=(2, 3), depths=(2, 3))
    report = reports.model_report(runs, encoded.preprocessing, 1.5, SEEDS).first()
    rows = {r["model"]: r for r in board.collect()}
    assert [r["model"] for r in report["classification"]] == ["dummy", "logistic", "tree", "boosted"]
    for r in report["classification"]:
        assert r["metrics"]["f1_macro"] == rows[r["model"]]["f1_macro"] and r["metrics"].get("roc_auc") == rows[r["model"]]["roc_auc"]
    assert report["best_classifier"] == max(rows, key=lambda m: (rows[m]["f1_macro"], -rows[m]["position"]))
    assert all(r["settings"] == runs.ended("ladder")["regression", r["model"], -1, -1].settings for r in report["regression"] if r["model"] == "ridge")
    assert settings_of(cls["tree"])["maxDepth"] == 3
    only = report["searches"][0]
    assert (only["run"], only["draws"], only["fits"]) == ("random_search_regression", 2, 6)
    assert only["best_settings"] == found.best().settings and only["best_metric"] == found.best().metric
    assert found.model().stages[0].getNumTrees in (2, 3)
    # A rung that was fitted is loaded, not fitted again.
    loaded, _ = ladder.rung("tree", cls["tree"], encoded, "classification", runs)
    assert loaded.toDebugString == models["tree"].toDebugString
    assert runs.of("ladder-fit").where("model = 'tree' AND task = 'classification'").count() == 1


def test_saved_models_and_stream_score_alike(spark, labelled, encoded):
    train = encoded.side("train")
    known = written(labelled.withColumn("year", F.lit(2023) - F.col("car_age")), "known-listings")
    fitted = scoring.Valuer(ladder.complete(encoded, ladder.tree_classifier(4).fit(train)),
                            ladder.complete(encoded, ladder.Ridge().fit(train)), 20000.0, power_medians(known))
    loaded = scoring.model_load(spark, scoring.model_save(fitted, spark, scratch(spark, "saved")))
    assert loaded.threshold == 20000.0
    asked = labelled.select(
        F.col("listing_id").cast("int").alias("request_id"), "brand", "model", "fuel_type", "transmission_type", "power_ps",
        "mileage_in_km", (F.lit(2023) - F.col("car_age")).cast("int").alias("min_year")).withColumn(
        "max_year", F.col("min_year"))
    values = lambda df: {r["request_id"]: (r["price"], r["p_high"], r["segment_name"]) for r in df.collect()}
    # An unknown power, an unseen brand and a year out of bounds are requests like others.
    odd = [(1001, "nobody", "Nobody X", "Petrol", "Manual", None, 50000.0, 2015, 2015), (1002, "nobody", "Nobody X", "Petrol", "Manual", 100.0, 50000.0, 1950, 2015),
           (1003, None, None, None, None, None, None, 2015, 2015)]
    asked = written(asked.unionByName(spark.createDataFrame(odd, asked.schema)), "asked")
    ok, wrong = split_requests(asked, Scope())
    valid = {r["request_id"] for r in ok.select("request_id").collect()}
    assert 1001 in valid and {1002, 1003}.isdisjoint(valid)
    batch = values(scoring.score_listings(ok, fitted, Scope()))
    assert values(scoring.score_listings(ok, loaded, Scope())) == batch and set(batch) == valid
    # Scores of a saved model read the requests and the saved medians, and no listing.
    read = [f for f in scoring.score_listings(ok, loaded, Scope()).inputFiles() if "asked" not in f]
    assert read and all("/medians/" in f for f in read)
    for r in scoring.score_listings(ok, fitted, Scope()).limit(20).collect():
        assert r["confidence"] == max(r["p_low"], r["p_high"]) and r["outside_scope"] == (not 500 <= r["price"] <= 80000)
    folder, out, rejects, log = (scratch(spark, n) for n in ("in", "out", "rejects", "log"))
    asked.repartition(3).write.parquet(folder)

    def streamed():
        stream = read_requests(spark, folder, asked.schema, files_per_trigger=1)
        for query in score_stream(stream, loaded, Scope(), out, rejects, log, {"availableNow": True}):
            assert query.awaitTermination(300)

    streamed()
    assert values(spark.read.parquet(out)) == batch
    refused = {r["request_id"]: r["rejected_for"] for r in spark.read.parquet(rejects).collect()}
    assert refused[1002] == "year" and refused[1003] == "mileage"
    assert set(refused) | valid == {r["request_id"] for r in asked.collect()} and valid.isdisjoint(refused)
    # A restart finds nothing new and repeats nothing.
    streamed()
    assert spark.read.parquet(out).count() == len(valid) and spark.read.parquet(rejects).count() == len(refused)


def test_split_tables(spark, labelled):
    sides = {r["split"]: r["n"] for r in write_splits(labelled, scratch(spark, "splits")).collect()}
    assert sum(sides.values()) == 600 and set(sides) == {"train", "test"}
