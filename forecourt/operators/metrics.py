"""Exact metrics over scored rows.

Classifier input: `label` and `prediction` (0 or 1) and `score`, the probability of HIGH. Regressor
input: `label` and `prediction`. All but the ranking metrics are one aggregation; `by` adds groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.operators.ordering import balanced_cuts, running_totals, with_range
from forecourt.sources.storage import written


def confusion_counts(scored: DataFrame, by=()) -> DataFrame:
    cell = lambda y, p: F.count_if((F.col("label") == y) & (F.col("prediction") == p))
    return scored.groupBy(*by).agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(0, 0).alias("tn"), cell(1, 0).alias("fn"))


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Counts of actual by predicted class; classes that never occur count 0."""
    cells = confusion_counts(scored)
    row = lambda y, low, high: F.struct(
        F.lit(y).alias("actual"), F.col(low).alias("predicted_low"), F.col(high).alias("predicted_high"))
    return cells.select(F.inline(F.array(row(0, "tn", "fp"), row(1, "fn", "tp"))))


def _ratio(a, b):
    return F.when(b > 0, a / F.when(b > 0, b)).otherwise(F.lit(0.0))


def classification_metrics(scored: DataFrame, by=(), decimals: int | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 for HIGH, and F1 averaged over the classes that occur."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    f1 = lambda t: _ratio(2.0 * t, 2 * t + fp + fn)
    n = tp + fp + tn + fn
    occurs = lambda t: F.when(t + fp + fn > 0, 1).otherwise(0)
    metrics = {
        "accuracy": _ratio((tp + tn) * 1.0, n),
        "precision": _ratio(tp * 1.0, tp + fp),
        "recall": _ratio(tp * 1.0, tp + fn),
        "f1_binary": f1(tp),
        "f1_macro": _ratio(f1(tp) + f1(tn), occurs(tp) + occurs(tn)),
    }
    shown = {k: v if decimals is None else F.round(v, decimals) for k, v in metrics.items()}
    return confusion_counts(scored, by).select(*by, n.alias("n"), *[v.alias(k) for k, v in shown.items()])


def _by_score(scored: DataFrame, by=()) -> DataFrame:
    """The distinct scores with the HIGH and LOW rows at each and the range of the score, written once."""
    merged = written(scored.groupBy(*by, F.col("score").cast("double").alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")), "by-score")
    return with_range(merged, "score", balanced_cuts(merged, ["score"])[0])


def roc_auc(scored: DataFrame, by=()) -> DataFrame:
    """Exact area under the curve; equal scores count half. NULL where only one class occurs."""
    below = running_totals(_by_score(scored, by), list(by), "score", ["neg"])
    # Of the LOW rows up to a score, those at the score itself are ties.
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_run") - F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return below.groupBy(*by).agg((wins / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def roc_curve(scored: DataFrame, drop_collinear: bool = True) -> DataFrame:
    """Rates per threshold, highest first, from the point (0, 0) on.

    An inner threshold whose next lower neighbour adds the same numbers of HIGH and LOW rows lies on a
    straight line and is left out unless told otherwise; the highest and the lowest stay.
    """
    ranged = _by_score(scored)
    totals = ranged.agg(F.struct(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.max("score").alias("top"))).scalar()
    curve = running_totals(ranged, [], "score", ["pos", "neg"], descending=True)
    if drop_collinear:
        # The neighbour of the last score in a range is the first score of the next range.
        heads = ranged.groupBy("_range").agg(F.max_by(F.struct("pos", "neg"), "score").alias("head"))
        down = Window.orderBy(F.desc("_range"))
        following = heads.select("_range", F.lead("head").over(down).alias("_head"))
        inside = Window.partitionBy("_range").orderBy(F.desc("score"))
        step = F.struct("pos", "neg")
        curve = (
            curve.join(following, "_range")
            .withColumn("_next", F.coalesce(F.lead(step).over(inside), F.col("_head")))
        )
        curve = curve.filter(
            (F.col("score") == totals["top"]) | F.col("_next").isNull()
            | (F.col("_next.pos") != F.col("pos")) | (F.col("_next.neg") != F.col("neg")))
    points = curve.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("neg_run").cast("double"), totals["neg"]).alias("fpr"),
        F.try_divide(F.col("pos_run").cast("double"), totals["pos"]).alias("tpr"),
    )
    start = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def regression_metrics(scored: DataFrame, by=()) -> DataFrame:
    """R2 against the mean of the rows at hand, mean absolute and root mean squared error."""
    y, e = F.col("label").cast("double"), F.col("prediction") - F.col("label")
    scored = scored.withColumns({"_y": y, "_e": e})
    sse, sst = F.sum(F.col("_e") * F.col("_e")), F.var_pop("_y") * F.count("_y")
    r2 = F.when(sst > 0, 1 - sse / F.when(sst > 0, sst)).when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        r2.alias("r2"),
        F.avg(F.abs("_e")).alias("mae"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"),
    )


def residuals(scored: DataFrame) -> DataFrame:
    return scored.withColumn("residual", F.col("prediction") - F.col("label"))


def overfit_gap(leaderboard: DataFrame, train: str, test: str) -> DataFrame:
    return leaderboard.select("model", F.col(train), F.col(test), (F.col(train) - F.col(test)).alias("gap"))


def best_model(leaderboard: DataFrame, metric: str, order: str = "position") -> DataFrame:
    """The row with the highest metric; the first one on equal metrics."""
    best = F.max_by(F.struct("model", metric), F.struct(F.col(metric), -F.col(order)))
    return leaderboard.agg(best.alias("b")).select("b.model", F.col(f"b.{metric}").alias(metric))


def beats_baseline(leaderboard: DataFrame, metric: str, baseline: str) -> DataFrame:
    """Every model against the baseline row."""
    floor = leaderboard.filter(F.col("model") == baseline).select(metric).scalar()
    verdict = (
        F.when(F.col("model") == baseline, F.lit("baseline"))
        .when(F.col(metric) > floor, F.lit("beats baseline"))
        .otherwise(F.lit("does not beat baseline"))
    )
    return leaderboard.select("model", metric, verdict.alias("verdict"))
