"""The model ladder: dummy, linear, tree and boosted, for the price segment and for the price.

The encoding is fitted once on the training rows and its vectors are written to the shared folder; every
model of the ladder is fitted on that table. Searches refit the encoding inside each fold instead.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.config import SEGMENT, TARGET, Seeds
from forecourt.operators.metrics import classification_metrics, regression_metrics, roc_auc
from forecourt.plans.encode import preprocess
from forecourt.plans.registry import Registry, settings_of
from forecourt.plans.trees import DecisionTreeClassifier, DecisionTreeRegressor, GBTClassifier, GBTRegressor
from forecourt.sources.storage import scratch, written

#: Rows that one task of a fit takes: every level of every tree costs a task for each partition.
ROWS_PER_TASK = 25_000
#: The same of a linear fit, once all cores have a task.
ROWS_PER_LINEAR_TASK = 250_000


class RidgeLogistic(Estimator, HasFeaturesCol, HasLabelCol, HasMaxIter):
    """Logistic regression with the penalty stated as C, the inverse strength over the summed loss.

    Spark averages the loss over the rows, so its penalty is 1 / (C * rows).
    """

    c = Param(Params._dummy(), "c", "inverse penalty", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, c=10.0, maxIter=500, featuresCol="features", labelCol=SEGMENT):
        super().__init__()
        self._setDefault(c=10.0, maxIter=500, featuresCol="features", labelCol=SEGMENT)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        rows = df.count()
        fitted = LogisticRegression(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), maxIter=self.getMaxIter(),
            regParam=1.0 / (self.getOrDefault(self.c) * rows), elasticNetParam=0.0, standardization=False).fit(df)
        # A fresh fit drags its training summary, and with it the session, into every task; that fails as
        # soon as the session has observed a query. The stored model has no summary.
        path = scratch(df.sparkSession, "logistic")
        fitted.write().save(path)
        return LogisticRegressionModel.load(path)


class Ridge(Estimator, HasFeaturesCol, HasLabelCol):
    """Least squares with the penalty alpha on the summed squares.

    Spark scales the label by its sample deviation and averages over the rows; the factor undoes both.
    """

    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, alpha=0.1, featuresCol="features", labelCol=TARGET):
        super().__init__()
        self._setDefault(alpha=0.1, featuresCol="features", labelCol=TARGET)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        y = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(self.getLabelCol()).alias("s")).first()
        return LinearRegression(
            # One pass over the rows and an exact solution for up to 4,096 features, else iterations.
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), solver="auto", maxIter=500, tol=1e-9,
            regParam=self.getOrDefault(self.alpha) * y["s"] / y["n"], elasticNetParam=0.0,
            standardization=False).fit(df)


# The published settings of the boosted rungs.
@dataclass(frozen=True)
class Boosting:
    """Boosted-tree settings; the defaults are the ones a search once found."""

    rounds: int = 271
    depth: int = 7
    rate: float = 0.2426
    rows: float = 0.8898
    columns: float = 0.6749


def _boosted(cls, label: str, b: Boosting, seed: int):
    return cls(featuresCol="features", labelCol=label, maxIter=b.rounds, maxDepth=b.depth, stepSize=b.rate,
               subsamplingRate=b.rows, featureSubsetStrategy=str(b.columns), maxBins=256, seed=seed,
               cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=1024)


def tree_classifier(depth: int = 15, seed: int = 42):
    return DecisionTreeClassifier(featuresCol="features", labelCol=SEGMENT, maxDepth=depth, maxBins=256, seed=seed,
                                  maxMemoryInMB=1024)


def tree_regressor(depth: int = 15, seed: int = 42):
    return DecisionTreeRegressor(featuresCol="features", labelCol=TARGET, maxDepth=depth, maxBins=256, seed=seed,
                                 maxMemoryInMB=1024)


def boosted_classifier(b: Boosting = Boosting(), seed: int = 42):
    return _boosted(GBTClassifier, SEGMENT, b, seed)


def boosted_regressor(b: Boosting = Boosting(), seed: int = 42):
    return _boosted(GBTRegressor, TARGET, b, seed)


def classifiers(b: Boosting = Boosting(), depth: int = 15, seed: int = 42) -> dict[str, Estimator]:
    """The fitted rungs in order; the dummy rung needs no estimator."""
    return {
        "logistic": RidgeLogistic(c=10.0, maxIter=500),
        "tree": tree_classifier(depth, seed),
        "boosted": boosted_classifier(b, seed),
    }


def regressors(b: Boosting = Boosting(), depth: int = 15, seed: int = 42) -> dict[str, Estimator]:
    return {
        "ridge": Ridge(alpha=0.1),
        "tree": tree_regressor(depth, seed),
        "boosted": boosted_regressor(b, seed),
    }


def dummy_classifier(train: DataFrame, df: DataFrame, label: str = SEGMENT) -> DataFrame:
    """Predicts the majority class of the training rows, the lower class on a tie, with certainty."""
    sizes = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    majority = sizes.agg(F.max_by(label, F.struct(F.col("n"), -F.col(label)))).scalar()
    return df.withColumn("prediction", majority.cast("double")).withColumn("score", F.col("prediction"))


def dummy_regressor(train: DataFrame, df: DataFrame, label: str = TARGET) -> DataFrame:
    """Predicts the mean of the training rows."""
    return df.withColumn("prediction", train.agg(F.avg(label)).scalar())


@dataclass(frozen=True)
class Encoded:
    """Encoded training and test rows and the fitted preprocessing."""

    rows: DataFrame
    preprocessing: PipelineModel

    def side(self, split: str) -> DataFrame:
        return self.rows.filter(F.col("split") == split)


def encode(labelled: DataFrame, seeds: Seeds = Seeds(), keep=("listing_id",)) -> Encoded:
    """Fits the preprocessing on the training rows and encodes all rows once."""
    fitted = preprocess(labelled.filter(F.col("split") == "train"), seeds)
    vectors = fitted.transform(labelled).select(*keep, "split", TARGET, SEGMENT, "features")
    return Encoded(written(vectors, "encoded", "split"), fitted)


def scored_rows(model, rows: DataFrame, label: str) -> DataFrame:
    """Rows with label, prediction and, for a classifier, the probability of HIGH as score."""
    out = model.transform(rows)
    score = [vector_to_array("probability")[1].alias("score")] if "probability" in out.columns else []
    return out.select("split", F.col(label).cast("double").alias("label"), "prediction", *score)


def _sides(metrics: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """One row from the metrics per split: column name -> (split, metric)."""
    return metrics.agg(*[F.max(F.when(F.col("split") == s, F.col(m))).alias(c) for c, (s, m) in wanted.items()])


def classifier_row(position: int, name: str, scored: DataFrame, seconds: float) -> DataFrame:
    """The metrics of one classifier on test and training rows."""
    row = _sides(classification_metrics(scored, ["split"]), {
        "accuracy": ("test", "accuracy"), "precision": ("test", "precision"), "recall": ("test", "recall"),
        "f1_binary": ("test", "f1_binary"), "f1_macro": ("test", "f1_macro"),
        "train_accuracy": ("train", "accuracy"), "train_f1_macro": ("train", "f1_macro"),
    })
    auc = roc_auc(scored.filter(F.col("split") == "test")).select("auc").scalar()
    return row.select(
        F.lit(position).alias("position"), F.lit(name).alias("model"),
        *[F.round(c, 4).alias(c) for c in ("accuracy", "precision", "recall", "f1_binary", "f1_macro")],
        F.round(auc, 4).alias("roc_auc"),
        *[F.round(c, 4).alias(c) for c in ("train_accuracy", "train_f1_macro")],
        F.lit(round(seconds, 1)).alias("fit_seconds"),
    )


def regressor_row(position: int, name: str, scored: DataFrame, seconds: float) -> DataFrame:
    row = _sides(regression_metrics(scored, ["split"]), {
        "r2": ("test", "r2"), "mae": ("test", "mae"), "rmse": ("test", "rmse"),
        "train_r2": ("train", "r2"), "train_rmse": ("train", "rmse"),
    })
    return row.select(
        F.lit(position).alias("position"), F.lit(name).alias("model"),
        F.round("r2", 4).alias("r2"), F.round("mae", 0).alias("mae"), F.round("rmse", 0).alias("rmse"),
        F.round("train_r2", 4).alias("train_r2"), F.round("train_rmse", 0).alias("train_rmse"),
        F.lit(round(seconds, 1)).alias("fit_seconds"),
    )


@dataclass
class Ladder:
    """Leaderboards (DataFrames) and the fitted models by name."""

    classification: DataFrame
    regression: DataFrame
    classifiers: dict
    regressors: dict


def dealt(rows: DataFrame, estimator: Estimator | None = None) -> DataFrame:
    """Rows in no more partitions than they need, before a fit that passes over them again and again.

    A linear fit makes hundreds of passes over small sparse rows: beyond a task for each core, its tasks are larger.
    """
    n = rows.count()
    parts = -(-n // ROWS_PER_TASK)
    if isinstance(estimator, (Ridge, RidgeLogistic)):
        parts = min(parts, max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_PER_LINEAR_TASK)))
    return rows.coalesce(max(1, parts))


def timed_fit(estimator: Estimator, rows: DataFrame):
    start = time.monotonic()
    model = estimator.fit(dealt(rows, estimator))
    return model, time.monotonic() - start


LADDER = "ladder"


def rung(name: str, estimator: Estimator, encoded: Encoded, task: str, registry: Registry | None = None):
    """A fitted rung with its time. A rung that the registry has with these settings is loaded instead."""
    if registry is None:
        return timed_fit(estimator, encoded.side("train"))

    def make():
        model, seconds = timed_fit(estimator, encoded.side("train"))
        path = scratch(registry.spark, f"rung-{name}")
        PipelineModel([model]).write().save(path)
        return {}, seconds, path

    held = registry.once(f"{LADDER}-fit", task, name, settings_of(estimator), make)
    return PipelineModel.load(held.path).stages[0], held.seconds


def _climb(encoded: Encoded, label: str, dummy, rungs: dict[str, Estimator], to_row, registry: Registry | None = None):
    train = encoded.side("train")
    task = "classification" if label == SEGMENT else "regression"
    # The dummy rung is part of the scored plan; it has no separate fit.
    base = dummy(train, encoded.rows, label).withColumn("label", F.col(label).cast("double"))
    board, models = to_row(0, "dummy", base, 0.0), {}
    for position, (name, estimator) in enumerate(rungs.items(), start=1):
        model, seconds = rung(name, estimator, encoded, task, registry)
        models[name] = model
        # A deep plan per model would be run again by every metric; the scores are kept instead.
        scored = written(scored_rows(model, encoded.rows, label), f"scored-{name}")
        board = board.unionByName(to_row(position, name, scored, seconds))
    board = written(board.coalesce(1), "leaderboard")
    if registry:
        for r in board.collect():
            settings = settings_of(rungs[r.model]) if r.model in rungs else {"strategy": "most_frequent" if label == SEGMENT else "mean"}
            metrics = {c: r[c] for c in board.columns if c not in ("model", "fit_seconds")}
            registry.add(LADDER, task, r.model, settings, metrics, r.fit_seconds)
    return board, models


def classification_ladder(encoded: Encoded, rungs=None, registry: Registry | None = None):
    """The leaderboard and the models. With a registry the metrics of every rung are added to it, and fits that it has
    are loaded."""
    return _climb(encoded, SEGMENT, dummy_classifier, rungs or classifiers(), classifier_row, registry)


def regression_ladder(encoded: Encoded, rungs=None, registry: Registry | None = None):
    return _climb(encoded, TARGET, dummy_regressor, rungs or regressors(), regressor_row, registry)


def train_ladder(labelled: DataFrame, boosting: Boosting = Boosting(), seeds: Seeds = Seeds()) -> tuple[Encoded, Ladder]:
    encoded = encode(labelled, seeds)
    cls_board, cls_models = classification_ladder(encoded, classifiers(boosting, seed=seeds.seed))
    reg_board, reg_models = regression_ladder(encoded, regressors(boosting, seed=seeds.seed))
    return encoded, Ladder(cls_board, reg_board, cls_models, reg_models)


def leaderboard(rows: list[DataFrame]) -> DataFrame:
    """Metric rows of several models as one table."""
    board = rows[0]
    for row in rows[1:]:
        board = board.unionByName(row)
    return board


def complete(encoded: Encoded, model) -> PipelineModel:
    """Preprocessing and model as one object that takes feature columns."""
    return PipelineModel([*encoded.preprocessing.stages, model])


def feature_importance(spark, model, names: list[tuple[str, str, bool]], top: int = 20) -> DataFrame:
    """The most important encoded features of a tree model, by name."""
    kept = [name for name, _, keep in names if keep]
    rows = [(kept[i], float(v)) for i, v in enumerate(model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature").limit(top)
