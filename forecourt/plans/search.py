"""Hyperparameter searches with cross-validation over hashed folds, which go on where they stopped.

The encoding is fitted in every fold on that fold's own rows, so no validation row takes part in it, and its vectors are
written once and read by every setting. Each fit is a run of the registry under its draw and fold.
"""

from __future__ import annotations

import random
import time
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from threading import Event

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from forecourt.config import SEGMENT, TARGET, Seeds
from forecourt.operators.metrics import classification_metrics, regression_metrics
from forecourt.operators.splitting import fold_assign
from forecourt.plans.encode import preprocess
from forecourt.plans.ladder import (
    Ridge, RidgeLogistic, boosted_classifier, boosted_regressor, dealt, tree_classifier, tree_regressor,
)
from forecourt.plans.registry import Registry, settings_of, settings_text
from forecourt.sources.storage import scratch, written


class MacroF1(Evaluator):
    """F1 averaged over the classes; Spark's own `f1` weighs classes by size."""

    def _evaluate(self, scored: DataFrame) -> float:
        rows = scored.select(F.col(SEGMENT).alias("label"), "prediction")
        return classification_metrics(rows).first()["f1_macro"]


class RootMeanSquare(Evaluator):
    def _evaluate(self, scored: DataFrame) -> float:
        return regression_metrics(scored.select(F.col(TARGET).alias("label"), "prediction")).first()["rmse"]

    def isLargerBetter(self) -> bool:
        return False


# Grids and ranges that the searches look through.
C_GRID = (0.01, 0.1, 1.0, 10.0)
ALPHA_GRID = (0.1, 1.0, 10.0, 100.0, 1000.0)
DEPTH_GRID = (5, 10, 15, 30)  # 30 is the deepest tree Spark grows, in the place of "no limit"
ROUNDS = (200, 399)
DEPTHS = (5, 8)
RATES = (0.10, 0.25)
ROW_SHARES = (0.80, 0.95)
COLUMN_SHARES = (0.60, 0.80)

ALL = -1  # in the place of a fold: every row is fitted


def random_maps(estimator, draws: int = 6, seed: int = 42, rounds=ROUNDS, depths=DEPTHS) -> list[dict]:
    """Random settings of a boosted estimator, the same for the same seed."""
    rng = random.Random(seed)
    return [
        {
            estimator.maxIter: rng.randint(*rounds),
            estimator.maxDepth: rng.randint(*depths),
            estimator.stepSize: rng.uniform(*RATES),
            estimator.subsamplingRate: rng.uniform(*ROW_SHARES),
            estimator.featureSubsetStrategy: str(round(rng.uniform(*COLUMN_SHARES), 4)),
        }
        for _ in range(draws)
    ]


def encoded_folds(train: DataFrame, classify: bool, registry: Registry, seeds: Seeds = Seeds(), key: str = "listing_id",
                  folds=None) -> dict[int, str]:
    """Where each fold's encoded rows lie: in `fit` and, those that validate, in `held`. Folds keep the class shares for a
    classifier. What a registry has is not encoded again, whatever the search that asks."""
    task = "classification" if classify else "regression"
    strata = [SEGMENT] if classify else []
    wanted = range(seeds.folds) if folds is None else folds
    folded: list[DataFrame] = []
    places = {}
    for fold in wanted:
        def make(fold=fold):
            if not folded:
                folded.append(written(fold_assign(train, key, strata, seeds), "folds"))
            start = time.monotonic()
            rows = folded[0].withColumn("held", F.col("fold") == fold)
            path = scratch(train.sparkSession, "fold")
            vectors = preprocess(rows.where("not held"), seeds).transform(rows).select(TARGET, SEGMENT, "held", "features")
            for side, kept in (("fit", "not held"), ("held", "held")):
                vectors.where(kept).drop("held").write.parquet(f"{path}/{side}")
            return {}, time.monotonic() - start, path

        settings = {"fold": fold, "folds": seeds.folds, "seed": seeds.seed, "least": seeds.min_model_rows}
        places[fold] = registry.once(f"encoding-{task}", task, f"fold{fold}", settings, make).path
    return places


@dataclass(frozen=True)
class Searched:
    """A search that ended: its runs are rows of the registry."""

    registry: Registry
    name: str
    folds: int
    larger: bool

    def table(self) -> DataFrame:
        """The settings tried, their mean metric over the folds, and the best of them, the first one on ties."""
        tried = self.registry.of(self.name).where("fold >= 0").groupBy("draw", "settings").agg(
            F.avg(F.col("metrics")["metric"]).alias("metric"), F.count("*").alias("fits"), F.sum("seconds").alias("seconds"))
        order = F.struct(F.col("metric") if self.larger else -F.col("metric"), -F.col("draw"))
        best = tried.agg(F.max_by("draw", order)).scalar()
        return tried.withColumn("best", F.col("draw") == best)

    def best(self) -> Row:
        return self.table().where("best").first()

    def model(self) -> PipelineModel:
        """The model of the best settings, fitted on all training rows."""
        refit = self.registry.of(self.name).where(F.col("fold") == ALL).first()
        return PipelineModel.load(refit.path)


def cross_validate(train: DataFrame, name: str, estimator, maps: list[dict], classify: bool, registry: Registry,
                   seeds: Seeds = Seeds(), key: str = "listing_id", parallelism: int = 2, refit: bool = True) -> Searched:
    """Fits every setting on every fold and the best one on all training rows.

    A fit that the registry has under this name, with the same settings, is not repeated: a search that was cut off
    repeats at most the fits that were running. `parallelism` fits run at a time.
    """
    spark = train.sparkSession
    task = "classification" if classify else "regression"
    evaluator = MacroF1() if classify else RootMeanSquare()
    kind = type(estimator).__name__
    places = encoded_folds(train, classify, registry, seeds, key)
    texts = [settings_text(settings_of(estimator, m)) for m in maps]
    done = {k for k, r in registry.ended(name).items() if 0 <= r.draw < len(texts) and r.settings == texts[r.draw]}
    open_fits = [(draw, fold) for draw in range(len(maps)) for fold in range(seeds.folds) if (task, kind, draw, fold) not in done]

    lost = Event()

    def fit(at: tuple[int, int]) -> None:
        if lost.is_set():
            return
        try:
            fit_one(*at)
        except BaseException:
            lost.set()  # no further fit begins
            raise

    def fit_one(draw: int, fold: int) -> None:
        start = time.monotonic()
        model = estimator.fit(dealt(spark.read.parquet(f"{places[fold]}/fit"), estimator), maps[draw])
        seconds = time.monotonic() - start
        metric = evaluator.evaluate(model.transform(spark.read.parquet(f"{places[fold]}/held")))
        registry.add(name, task, kind, settings_of(estimator, maps[draw]), {"metric": metric}, seconds, draw, fold)

    # The longest fits first, so that none of them is left alone at the end.
    cost = lambda at: sum(v for p, v in maps[at[0]].items() if p.name in ("maxIter", "maxDepth"))
    with ThreadPool(parallelism) as pool:
        try:
            for _ in pool.imap_unordered(inheritable_thread_target(spark)(fit), sorted(open_fits, key=cost, reverse=True)):
                pass
        finally:  # fits that were running when another one failed end before the search does
            pool.close()
            pool.join()
    found = Searched(registry, name, seeds.folds, evaluator.isLargerBetter())
    if refit:
        best = found.best()
        held = registry.ended(name).get((task, kind, best.draw, ALL))
        if held is None or held.settings != best.settings:
            path = encoded_folds(train, classify, registry, seeds, key, folds=[ALL])[ALL]
            start = time.monotonic()
            model = estimator.fit(dealt(spark.read.parquet(f"{path}/fit"), estimator), maps[best.draw])
            seconds, place = time.monotonic() - start, scratch(spark, "refit")
            PipelineModel([model]).write().save(place)
            registry.add(name, task, kind, settings_of(estimator, maps[best.draw]), {}, seconds, best.draw, ALL, place)
    return found


def random_search(train: DataFrame, classify: bool, registry: Registry, draws: int = 6, seeds: Seeds = Seeds(), rounds=ROUNDS,
                  depths=DEPTHS, key: str = "listing_id", parallelism: int = 2) -> Searched:
    """Random settings of the boosted rung: `draws` of them, each fitted on every fold."""
    estimator = boosted_classifier(seed=seeds.seed) if classify else boosted_regressor(seed=seeds.seed)
    name = f"random_search_{'classification' if classify else 'regression'}"
    return cross_validate(train, name, estimator, random_maps(estimator, draws, seeds.seed, rounds, depths), classify,
                          registry, seeds, key, parallelism)


def grid_search(train: DataFrame, which: str, registry: Registry, values=None, seeds: Seeds = Seeds(),
                key: str = "listing_id", parallelism: int = 2) -> Searched:
    """Grid over one setting: `logistic` (C), `ridge` (alpha), `tree_classifier` or `tree_regressor` (depth)."""
    logistic, ridge, tree_c, tree_r = RidgeLogistic(), Ridge(), tree_classifier(), tree_regressor()
    estimator, param, default, classify = {
        "logistic": (logistic, logistic.c, C_GRID, True),
        "ridge": (ridge, ridge.alpha, ALPHA_GRID, False),
        "tree_classifier": (tree_c, tree_c.maxDepth, DEPTH_GRID, True),
        "tree_regressor": (tree_r, tree_r.maxDepth, DEPTH_GRID, False),
    }[which]
    maps = ParamGridBuilder().addGrid(param, list(values or default)).build()
    return cross_validate(train, f"grid_search_{which}", estimator, maps, classify, registry, seeds, key, parallelism)
