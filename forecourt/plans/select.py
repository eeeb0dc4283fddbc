"""Selection of encoded features: by their F score, or by recursive elimination. Both give a stage that slices vectors."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feature_scores(rows: DataFrame, label: str, features: str = "features") -> DataFrame:
    """(position, score, n): the F score of every feature against the label, from one pass over the vectors.

    The score of a simple regression of the label on the feature, which for a label of 0 and 1 is the analysis of variance
    of two classes. Only values that are not zero are exploded, some ten of a sparse vector; sums merge before the
    shuffle. A constant feature scores 0; one that decides the label has no bound and scores infinity. Rows without label
    are left out.
    """
    known = rows.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("_y"), F.unwrap_udt(F.col(features)).alias("_v"))
    places = F.coalesce("_v.indices", F.sequence(F.lit(0), F.size("_v.values") - 1))
    size = known.agg(F.max(F.coalesce("_v.size", F.size("_v.values")))).scalar()
    # The label is centred first: its sums stay small against the squares.
    middle = known.agg(F.avg("_y")).scalar()
    centred = known.withColumn("_y", F.col("_y") - middle)
    sums = centred.select("_y", F.inline(F.arrays_zip(places.alias("position"), F.col("_v.values").alias("x")))).groupBy("position").agg(
        F.sum("x").alias("x"), F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("x") * F.col("_y")).alias("xy"))
    totals = centred.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("y"), F.sum(F.col("_y") * F.col("_y")).alias("yy"))
    every = rows.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), size - 1)).alias("position")).where("position >= 0")
    one = lambda c: totals.select(c).scalar()
    n = one("n")
    found = every.join(sums, "position", "left").fillna(0.0, ["x", "xx", "xy"]).withColumn("n", n)
    spread = F.col("xx") - F.col("x") * F.col("x") / n
    along = F.col("xy") - F.col("x") * one("y") / n
    share = F.when(spread > 1e-12 * F.col("xx"), F.try_divide(along * along, spread * (one("yy") - one("y") * one("y") / n)))
    score = F.when(share.isNull(), 0.0).when(share >= 1, float("inf")).otherwise(share / (1 - share) * (n - 2))
    return found.select("position", score.alias("score"), "n")


class _Selector(Estimator, HasFeaturesCol, HasLabelCol, HasOutputCol):
    k = Param(Params._dummy(), "k", "features to keep", TypeConverters.toInt)

    def _slicer(self, kept: list[int]) -> VectorSlicer:
        return VectorSlicer(inputCol=self.getFeaturesCol(), outputCol=self.getOutputCol(), indices=sorted(kept))


class BestScores(_Selector):
    """Keeps the k features with the highest F scores; of equal ones the earlier."""

    @keyword_only
    def __init__(self, *, k=10, featuresCol="features", labelCol="label", outputCol="selected"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(k=10, featuresCol="features", labelCol="label", outputCol="selected")

    def _fit(self, df: DataFrame) -> VectorSlicer:
        scores = feature_scores(df, self.getLabelCol(), self.getFeaturesCol())
        best = scores.orderBy(F.desc("score"), "position").limit(self.getOrDefault(self.k))
        return self._slicer([r.position for r in best.collect()])


class RecursiveElimination(_Selector):
    """Fits a linear estimator again and again, each time without the `step` features of the smallest weight, until k are left.

    The encoded table is read for every fit and made once; a fit sees a slice of its vectors. Weights are compared as they are:
    features should be scaled alike. Of equal weights the later feature goes first. `ranking_`: by position the round
    in which a feature went, 0 for those kept.
    """

    step = Param(Params._dummy(), "step", "features that go at a time", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, k=10, step=1, featuresCol="features", labelCol="label", outputCol="selected"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(k=10, step=1, featuresCol="features", labelCol="label", outputCol="selected")
        self.estimator = None
        self.ranking_ = {}

    def using(self, estimator: Estimator) -> "RecursiveElimination":
        """The estimator whose weights count; it reads the column `outputCol`."""
        self.estimator = estimator
        return self

    def _fit(self, df: DataFrame) -> VectorSlicer:
        first = df.select(F.unwrap_udt(F.col(self.getFeaturesCol())).alias("v")).select(F.coalesce("v.size", F.size("v.values"))).first()
        left, k, round_ = list(range(first[0] if first else 0)), self.getOrDefault(self.k), 0
        self.ranking_ = dict.fromkeys(left, 0)
        while len(left) > k:
            round_ += 1
            fitted = self.estimator.fit(self._slicer(left).transform(df))
            weights = abs(fitted.coefficients.toArray())
            order = sorted(range(len(left)), key=lambda i: (weights[i], -i))
            gone = {left[i] for i in order[: min(self.getOrDefault(self.step), len(left) - k)]}
            self.ranking_.update(dict.fromkeys(gone, round_))
            left = [f for f in left if f not in gone]
        return self._slicer(left)
