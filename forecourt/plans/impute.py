"""Filling of missing values as a savable stage: medians of numbers, the most frequent text."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.operators.ordering import group_quantiles
from forecourt.operators.profiling import long_form


class _Columns(HasInputCols):
    textCols = Param(Params._dummy(), "textCols", "text columns to fill", TypeConverters.toListString)


class MissingValues(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the exact median of each number column (`inputCols`) and the most frequent value of each text column (`textCols`).

    Of equally frequent texts the first by name counts. Only the rows given to `fit` are looked at: give the training
    rows. A column without any value is left as it is. The driver gets a value for each column.
    """

    @keyword_only
    def __init__(self, *, inputCols=(), textCols=()):
        super().__init__()
        self._setDefault(inputCols=[], textCols=[])
        self._set(**{k: list(v) for k, v in self._input_kwargs.items()})

    def _fit(self, df: DataFrame) -> "MissingValuesModel":
        numbers, texts = self.getInputCols(), self.getOrDefault(self.textCols)
        medians, modes = {}, {}
        if numbers:
            known = df.select([F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in numbers])
            medians = {r.column_name: r.quantile for r in group_quantiles(long_form(known, numbers), ["column_name"], "value", [0.5]).collect()}
        if texts:
            counts = df.unpivot([], [F.col(c).cast("string").alias(c) for c in texts], "column_name", "value") \
                .where("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
            first = counts.groupBy("column_name").agg(F.min(F.struct(-F.col("n"), "value")).alias("first"))
            modes = {r.column_name: r.first.value for r in first.collect()}
        return MissingValuesModel(inputCols=[c for c in numbers if c in medians], textCols=[c for c in texts if c in modes],
                                  medians=[medians[c] for c in numbers if c in medians], modes=[modes[c] for c in texts if c in modes])


class MissingValuesModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fills missing values, NaN among them, with what was learned. No shuffle; works on streams."""

    medians = Param(Params._dummy(), "medians", "value per number column", TypeConverters.toListFloat)
    modes = Param(Params._dummy(), "modes", "value per text column", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=(), textCols=(), medians=(), modes=()):
        super().__init__()
        self._set(**{k: list(v) for k, v in self._input_kwargs.items()})

    def by_column(self) -> dict:
        return {**dict(zip(self.getInputCols(), self.getOrDefault(self.medians), strict=True)),
                **dict(zip(self.getOrDefault(self.textCols), self.getOrDefault(self.modes), strict=True))}

    def _transform(self, df: DataFrame) -> DataFrame:
        numbers = set(self.getInputCols())
        known = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None)) if c in numbers else F.col(c)
        return df.withColumns({c: F.coalesce(known(c), F.lit(v)) for c, v in self.by_column().items()})
