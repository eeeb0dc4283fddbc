"""Metrics against their definitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.operators.metrics import (
    beats_baseline, best_model, classification_metrics, confusion_matrix, overfit_gap, regression_metrics, roc_auc,
    roc_curve,
)


@pytest.fixture(scope="module")
def scored():
    rng = np.random.default_rng(3)
    score = np.round(rng.random(400), 2)  # with ties
    label = (rng.random(400) < score).astype(int)
    return label, score


def frame(spark, label, score, cut=0.5):
    rows = [(int(y), int(s >= cut), float(s)) for y, s in zip(label, score)]
    return spark.createDataFrame(rows, "label int, prediction int, score double").repartition(3)


def pair_auc(label, score):
    high, low = score[label == 1], score[label == 0]
    return ((high[:, None] > low).sum() + 0.5 * (high[:, None] == low).sum()) / (len(high) * len(low))


def test_auc_is_the_share_of_ordered_pairs(spark, scored):
    label, score = scored
    df = frame(spark, label, score)
    assert roc_auc(df).first()["auc"] == pytest.approx(pair_auc(label, score), abs=1e-12)
    # Only the order of the scores counts.
    moved = df.withColumn("score", F.pow("score", F.lit(3.0)) - 7)
    assert roc_auc(moved).first()["auc"] == pytest.approx(pair_auc(label, score), abs=1e-12)
    assert roc_auc(df.filter("label = 1")).first()["auc"] is None


def expected_curve(label, score, drop):
    cuts = sorted(set(score), reverse=True)
    tps = np.array([((score >= c) & (label == 1)).sum() for c in cuts])
    fps = np.array([((score >= c) & (label == 0)).sum() for c in cuts])
    keep = np.ones(len(cuts), bool)
    if drop and len(cuts) > 2:
        keep[1:-1] = (np.diff(tps, 2) != 0) | (np.diff(fps, 2) != 0)
    tps, fps = tps[keep], fps[keep]
    return [(0.0, 0.0), *zip(fps / fps[-1], tps / tps[-1])]


@pytest.mark.parametrize("drop", [True, False])
def test_roc_curve(spark, scored, drop):
    label, score = scored
    got = sorted((r["fpr"], r["tpr"]) for r in roc_curve(frame(spark, label, score), drop).collect())
    assert np.allclose(got, sorted(expected_curve(label, score, drop)))


def test_classification_metrics(spark, scored):
    label, score = scored
    r = classification_metrics(frame(spark, label, score)).first()
    guess = (score >= 0.5).astype(int)
    f1 = lambda c: 2 * ((guess == c) & (label == c)).sum() / ((guess == c).sum() + (label == c).sum())
    assert r["accuracy"] == pytest.approx((guess == label).mean())
    assert r["f1_binary"] == pytest.approx(f1(1)) and r["f1_macro"] == pytest.approx((f1(0) + f1(1)) / 2)
    cells = {x["actual"]: (x["predicted_low"], x["predicted_high"])
             for x in confusion_matrix(frame(spark, label, score)).collect()}
    assert cells[1] == (((label == 1) & (guess == 0)).sum(), ((label == 1) & (guess == 1)).sum())


def test_nothing_predicted_high(spark):
    r = classification_metrics(frame(spark, [1, 0, 0, 0], [0.1, 0.2, 0.3, 0.1])).first()
    assert (r["precision"], r["recall"], r["f1_binary"]) == (0, 0, 0)
    assert r["f1_macro"] == pytest.approx((0 + 2 * 3 / 7) / 2)
    only = classification_metrics(frame(spark, [0, 0], [0.1, 0.2])).first()
    assert only["f1_macro"] == 1  # a class that never occurs takes no part


def test_regression_metrics(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(5, 2, 200), rng.normal(5, 2, 200)
    r = regression_metrics(spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)],
                                                 "label double, prediction double")).first()
    assert r["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert r["mae"] == pytest.approx(abs(y - p).mean()) and r["rmse"] == pytest.approx(((y - p) ** 2).mean() ** 0.5)
    same = regression_metrics(spark.createDataFrame([(3.0, 3.0), (3.0, 3.0)], "label double, prediction double"))
    assert same.first()["r2"] == 1


def test_leaderboard_views(spark):
    board = spark.createDataFrame([(0, "dummy", 0.3, 0.3), (1, "a", 0.9, 0.8), (2, "b", 0.95, 0.8), (3, "c", 0.2, 0.2)],
                                  "position int, model string, train_f1 double, f1 double")
    assert best_model(board, "f1").first()["model"] == "a"  # the first of equals
    verdicts = {r["model"]: r["verdict"] for r in beats_baseline(board, "f1", "dummy").collect()}
    assert verdicts == {"dummy": "baseline", "a": "beats baseline", "b": "beats baseline",
                        "c": "does not beat baseline"}
    gaps = {r["model"]: round(r["gap"], 4) for r in overfit_gap(board, "train_f1", "f1").collect()}
    assert gaps == {"dummy": 0, "a": 0.1, "b": 0.15, "c": 0}
