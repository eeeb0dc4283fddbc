"""The preprocessing fitted on training rows: one-hot columns, a bucket for rare models, scaled numbers."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    OneHotEncoder, OneHotEncoderModel, StringIndexer, StringIndexerModel, VarianceThresholdSelector,
    VarianceThresholdSelectorModel, VectorAssembler,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.config import CATEGORICAL, NUMERIC, Seeds

RARE = "infrequent"


class KnownText(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Missing text as a level of its own, so that it gets a column only if training rows had it."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({o: F.coalesce(F.col(i), F.lit("nan"))
                               for i, o in zip(self.getInputCols(), self.getOutputCols())})


def level_counts(train: DataFrame, column: str) -> DataFrame:
    return train.groupBy(F.col(column).alias("level")).agg(F.count(F.lit(1)).alias("n"))


def min_frequency_bucket(train: DataFrame, df: DataFrame, column: str = "model",
                         least: int = Seeds.min_model_rows) -> DataFrame:
    """Adds `<column>_level`: the level itself if training rows had it often enough, else the bucket.

    Without any rare level in training there is no bucket, and an unseen level becomes NULL.
    """
    counts = level_counts(train.select(F.coalesce(F.col(column), F.lit("nan")).alias(column)), column)
    frequent = counts.filter(F.col("n") >= least).select("level", F.lit(True).alias("_kept"))
    has_rare = counts.agg(F.count_if(F.col("n") < least) > 0).scalar()
    return (
        df.withColumn("level", F.coalesce(F.col(column), F.lit("nan"))).join(frequent, "level", "left")
        .withColumn(f"{column}_level", F.when(F.col("_kept"), F.col("level")).when(has_rare, F.lit(RARE)))
        .select(*df.columns, f"{column}_level")
    )


class RareLevelEncoder(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot columns for frequent levels and one shared column for rare and unseen ones.

    Fitting counts levels on the training rows. The fitted stages are Spark's own: an indexer that only
    knows the frequent levels sends everything else to its last slot, and that slot is the bucket.
    """

    minFrequency = Param(Params._dummy(), "minFrequency", "fewest training rows of a level", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, minFrequency=Seeds.min_model_rows):
        super().__init__()
        self._setDefault(minFrequency=Seeds.min_model_rows)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        least = self.getOrDefault(self.minFrequency)
        counts = level_counts(df, self.getInputCol())
        # The vocabulary of an encoder lives on the driver, as a string indexer's does; there are at most
        # rows / minFrequency levels in it.
        found = counts.agg(
            F.sort_array(F.collect_list(F.when(F.col("n") >= least, F.col("level")))).alias("frequent"),
            F.count_if(F.col("n") < least).alias("rare"),
        ).first()
        index = f"{self.getOutputCol()}_index"
        indexer = StringIndexerModel.from_labels(
            list(found["frequent"]), inputCol=self.getInputCol(), outputCol=index, handleInvalid="keep")
        encoder = OneHotEncoder(inputCols=[index], outputCols=[self.getOutputCol()], dropLast=found["rare"] == 0)
        return PipelineModel([indexer, encoder.fit(indexer.transform(df))])


class PopulationScaler(Estimator, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Centres columns and divides them by their population deviation into one vector column."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        columns = self.getInputCols()
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
        means = [float(row[f"m{i}"]) for i in range(len(columns))]
        # A constant column is only centred.
        stds = [float(row[f"s{i}"]) or 1.0 for i in range(len(columns))]
        return PopulationScalerModel(inputCols=columns, outputCol=self.getOutputCol(), means=means, stds=stds)


class PopulationScalerModel(Model, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "divisor per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, means=None, stds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def by_column(self) -> dict[str, tuple[float, float]]:
        return {c: (m, s) for c, m, s in
                zip(self.getInputCols(), self.getOrDefault(self.means), self.getOrDefault(self.stds))}

    def _transform(self, df: DataFrame) -> DataFrame:
        scaled = {f"_{c}_scaled": (F.col(c) - m) / s for c, (m, s) in self.by_column().items()}
        wide = df.withColumns(scaled)
        return VectorAssembler(inputCols=list(scaled), outputCol=self.getOutputCol()).transform(wide).drop(*scaled)


def standard_scale(train: DataFrame, df: DataFrame, columns=NUMERIC) -> DataFrame:
    """Adds `<column>_scaled` with the training mean and population deviation."""
    fitted = train.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns])).scalar()
    spread = lambda c: F.when(fitted[c]["std"] > 0, fitted[c]["std"]).otherwise(F.lit(1.0))
    return df.withColumns({f"{c}_scaled": (F.col(c) - fitted[c]["mean"]) / spread(c) for c in columns})


def onehot_stages(columns) -> list:
    """All levels of the training rows get a column; an unseen level gets zeros."""
    index, hot = [f"{c}_index" for c in columns], [f"{c}_onehot" for c in columns]
    return [
        StringIndexer(inputCols=[f"{c}_text" for c in columns], outputCols=index, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
    ]


PLAIN = tuple(c for c in CATEGORICAL if c != "model")
ASSEMBLED = ("brand_onehot", "model_onehot", "fuel_type_onehot", "transmission_type_onehot", "scaled")


def preprocessing(seeds: Seeds = Seeds(), select: bool = True) -> list:
    """Stages from feature columns to the vector `features`."""
    stages = [
        KnownText(inputCols=list(CATEGORICAL), outputCols=[f"{c}_text" for c in CATEGORICAL]),
        *onehot_stages(PLAIN),
        RareLevelEncoder(inputCol="model_text", outputCol="model_onehot", minFrequency=seeds.min_model_rows),
        PopulationScaler(inputCols=list(NUMERIC), outputCol="scaled"),
        VectorAssembler(inputCols=list(ASSEMBLED), outputCol="encoded" if select else "features"),
    ]
    if select:
        stages.append(VarianceThresholdSelector(
            featuresCol="encoded", outputCol="features", varianceThreshold=0.0))
    return stages


def preprocess(train: DataFrame, seeds: Seeds = Seeds()) -> PipelineModel:
    return Pipeline(stages=preprocessing(seeds)).fit(train)


def flat_stages(model: PipelineModel) -> list:
    """All fitted stages, those of nested pipelines in place."""
    return [s for stage in model.stages for s in (flat_stages(stage) if isinstance(stage, PipelineModel) else [stage])]


def feature_names(model: PipelineModel) -> list[tuple[str, str, bool]]:
    """(name, source column, kept) of every encoded feature in vector order."""
    labels, has_bucket, numbers, kept = {}, False, [], None
    for stage in flat_stages(model):
        if isinstance(stage, StringIndexerModel):
            # One indexer for the plain columns, one for the model levels.
            if stage.isSet("inputCols"):
                labels.update(zip(stage.getInputCols(), stage.labelsArray))
            else:
                labels[stage.getInputCol()] = stage.labels
        elif isinstance(stage, OneHotEncoderModel) and stage.getOutputCols() == ["model_onehot"]:
            has_bucket = not stage.getDropLast()
        elif isinstance(stage, PopulationScalerModel):
            numbers = stage.getInputCols()
        elif isinstance(stage, VarianceThresholdSelectorModel):
            kept = set(stage.selectedFeatures)
    names = []
    for c in CATEGORICAL:
        names += [(f"{c}_{level}", c) for level in labels[f"{c}_text"]]
        if c == "model" and has_bucket:
            names.append((f"model_{RARE}", "model"))
    names += [(c, c) for c in numbers]
    return [(name, source, kept is None or i in kept) for i, (name, source) in enumerate(names)]


def feature_inventory(spark, model: PipelineModel) -> DataFrame:
    """One row per encoded feature with its place, its source column and whether the selector kept it.

    A fitted encoder holds its vocabulary on the driver; this only shows it as a table.
    """
    rows = [(i, name, source, kept) for i, (name, source, kept) in enumerate(feature_names(model))]
    return spark.createDataFrame(rows, "position int, feature string, source string, kept boolean")


def scaler_means(model: PipelineModel) -> dict[str, float]:
    scaler = next(s for s in flat_stages(model) if isinstance(s, PopulationScalerModel))
    return {c: m for c, (m, _) in scaler.by_column().items()}
