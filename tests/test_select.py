"""F scores and recursive elimination beside numpy."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from forecourt.plans.ladder import Ridge
from forecourt.plans.select import BestScores, RecursiveElimination, feature_scores


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 8))
    x[:, 1] = (x[:, 1] > 1).astype(float)
    x[:, 2] = 0
    x[:, 3] = 5
    y = 3 * x[:, 0] - 2 * x[:, 4] + 0.5 * x[:, 1] + 0.01 * x[:, 6] + rng.standard_normal(400)
    return x, y


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y = data
    vectors = [Vectors.dense(r) if i % 2 else Vectors.sparse(8, [(j, v) for j, v in enumerate(r) if v]) for i, r in enumerate(x)]
    df = spark.createDataFrame([(v, float(t), int(t > 0)) for v, t in zip(vectors, y)], ["features", "y", "high"])
    return df.repartition(3)


@pytest.mark.parametrize("label", ["y", "high"])
def test_scores(rows, data, label):
    x, y = data
    y = y if label == "y" else (y > 0).astype(float)
    found = {r.position: r.score for r in feature_scores(rows, label).collect()}
    assert sorted(found) == list(range(8))
    for j in range(8):
        if x[:, j].std() == 0:
            assert found[j] == 0
            continue
        if label == "high":  # the analysis of variance of two classes
            a, b = x[y == 1, j], x[y == 0, j]
            between = len(a) * (a.mean() - x[:, j].mean()) ** 2 + len(b) * (b.mean() - x[:, j].mean()) ** 2
            want = between / ((((a - a.mean()) ** 2).sum() + ((b - b.mean()) ** 2).sum()) / (len(y) - 2))
        else:
            r = np.corrcoef(x[:, j], y)[0, 1]
            want = r * r / (1 - r * r) * (len(y) - 2)
        assert found[j] == pytest.approx(want, rel=1e-9)
    best = sorted(found, key=lambda j: (-found[j], j))[:3]
    slicer = BestScores(k=3, labelCol=label).fit(rows)
    assert slicer.getIndices() == sorted(best)
    assert slicer.transform(rows).first().selected.size == 3


def test_a_label_that_a_feature_decides_and_no_rows(spark, rows):
    same = rows.withColumn("y", F.element_at(F.unwrap_udt("features")["values"], 1)).where(F.unwrap_udt("features")["type"] == 1)
    assert feature_scores(same, "y").where("position = 0").first().score > 1e9
    assert feature_scores(rows.where("y > 1e9"), "y").count() == 0


def test_elimination_order(rows, data):
    x, y = data
    left, order = list(range(8)), []
    yc = y - y.mean()
    while len(left) > 2:
        xc = x[:, left] - x[:, left].mean(0)
        w = np.abs(np.linalg.solve(xc.T @ xc + 0.1 * np.eye(len(left)), xc.T @ yc))
        worst = min(range(len(left)), key=lambda i: (round(w[i], 9), -i))
        order.append(left.pop(worst))
    selector = RecursiveElimination(k=2, featuresCol="features", labelCol="y").using(Ridge(alpha=0.1, featuresCol="selected", labelCol="y"))
    assert selector.fit(rows).getIndices() == sorted(left)
    by_round = sorted((r, f) for f, r in selector.ranking_.items() if r)
    assert [f for _, f in by_round] == order
    fast = RecursiveElimination(k=2, step=4, labelCol="y").using(Ridge(alpha=0.1, featuresCol="selected", labelCol="y"))
    assert fast.fit(rows).getIndices() == sorted(left) and max(fast.ranking_.values()) == 2
