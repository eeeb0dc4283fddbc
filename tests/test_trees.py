"""Trees over sparse vectors against Spark's own, and what they hold of a row."""

import numpy as np
import pytest
from pyspark.ml import classification, regression
from pyspark.ml.linalg import Vectors

from forecourt.plans import trees

WIDE = 40


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    out = []
    for _ in range(700):
        level, x, z = int(rng.integers(0, WIDE)), float(rng.normal()), float(rng.integers(-3, 4))
        y = 40.0 * (level % 7) + 11.0 * x * (level % 3) + 5.0 * z + float(rng.normal())
        out.append((Vectors.sparse(WIDE + 3, {k: v for k, v in ((level, 1.0), (WIDE, x), (WIDE + 1, z)) if v}), y, float(y > 110)))
    return spark.createDataFrame(out, ["features", "y", "c"]).repartition(3).cache()


def said(model, rows):
    return np.array([r[0] for r in model.transform(rows).select("prediction").collect()])


@pytest.mark.parametrize("name, label", [("DecisionTreeRegressor", "y"), ("DecisionTreeClassifier", "c")])
@pytest.mark.parametrize("bins", [16, 256])
def test_trees_are_those_of_spark(rows, name, label, bins):
    module = regression if label == "y" else classification
    settings = dict(labelCol=label, maxDepth=5, maxBins=bins, seed=7)
    ours, theirs = getattr(trees, name)(**settings).fit(rows), getattr(module, name)(**settings).fit(rows)
    assert type(ours) is type(theirs) and ours.numNodes == theirs.numNodes and ours.depth == theirs.depth == 5
    assert np.allclose(said(ours, rows), said(theirs, rows), rtol=1e-9)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)


@pytest.mark.parametrize("name, label", [("GBTRegressor", "y"), ("GBTClassifier", "c")])
def test_boosting_without_draws_is_that_of_spark(rows, name, label):
    module = regression if label == "y" else classification
    settings = dict(labelCol=label, maxIter=4, maxDepth=3, maxBins=64, stepSize=0.3, seed=7, checkpointInterval=2)
    ours, theirs = getattr(trees, name)(**settings).fit(rows), getattr(module, name)(**settings).fit(rows)
    assert ours.getNumTrees == 4 and ours.treeWeights == theirs.treeWeights
    assert np.allclose(said(ours, rows), said(theirs, rows), rtol=1e-6)
    assert np.allclose(ours.evaluateEachIteration(rows, "squared") if label == "y" else ours.evaluateEachIteration(rows),
                       theirs.evaluateEachIteration(rows, "squared") if label == "y" else theirs.evaluateEachIteration(rows))


def test_drawn_rows_and_features_are_the_same_each_time(rows):
    settings = dict(labelCol="y", maxIter=3, maxDepth=3, subsamplingRate=0.8, featureSubsetStrategy="0.5", seed=7)
    first, second = (trees.GBTRegressor(**settings).fit(rows) for _ in range(2))
    assert np.array_equal(said(first, rows), said(second, rows))
    assert not np.array_equal(said(first, rows), said(trees.GBTRegressor(**{**settings, "seed": 8}).fit(rows), rows))


@pytest.mark.parametrize("name, label, more", [("DecisionTreeRegressor", "y", {}), ("DecisionTreeClassifier", "c", {}),
                                               ("GBTRegressor", "y", dict(maxIter=2, subsamplingRate=0.8, featureSubsetStrategy="0.5"))])
def test_nodes_of_few_rows_are_grown_in_one_job(rows, name, label, more, monkeypatch):
    jobs, level = [], trees.Learner.level
    monkeypatch.setattr(trees.Learner, "level", lambda me, *given, **named: jobs.append(1) or level(me, *given, **named))
    estimator = getattr(trees, name)(labelCol=label, maxDepth=7, maxBins=64, seed=7, **more)
    few = estimator.fit(rows)
    # The root, and for a tree the leaves that are children of it: not a job for each level.
    assert len(jobs) <= 2
    for most in (0, 150):  # every level a job, and nodes that grow small on the way
        monkeypatch.setattr(trees, "SUBTREE_ROWS", most)
        other = estimator.fit(rows)
        assert np.allclose(said(other, rows), said(few, rows), rtol=1e-9)
        assert np.allclose(other.featureImportances.toArray(), few.featureImportances.toArray(), atol=1e-9)


def test_a_row_is_held_as_what_its_vector_stores(spark):
    size, n = 60_000, 300
    wide = spark.createDataFrame([(Vectors.sparse(size, {k % 90: 1.0, size - 1: float(k)}), float(k % 90)) for k in range(n)], ["features", "y"])
    _, blocks, *_ = trees.DecisionTreeRegressor(labelCol="y")._prepared(wide, False)
    assert blocks.map(lambda b: len(b[0])).sum() <= 2 * n and blocks.map(lambda b: len(b[2])).sum() == n
    assert trees.DecisionTreeRegressor(labelCol="y", maxDepth=2).fit(wide).numFeatures == size


def test_rows_that_cannot_be_learnt_are_named(spark, rows):
    with pytest.raises(ValueError, match="no rows"):
        trees.DecisionTreeRegressor(labelCol="y").fit(rows.limit(0))
    with pytest.raises(Exception, match="NULL"):
        trees.DecisionTreeRegressor(labelCol="y").fit(rows.selectExpr("features", "if(y > 100, NULL, y) AS y"))


@pytest.mark.parametrize("name, label", [("GBTRegressor", "y"), ("GBTClassifier", "c")])
def test_all_rounds_of_a_small_table_are_one_job(rows, name, label, monkeypatch):
    jobs, level, small = [], trees.Learner.level, trees.ROUNDS_VALUES
    monkeypatch.setattr(trees.Learner, "level", lambda me, *given, **named: jobs.append(1) or level(me, *given, **named))
    # Rows of 1, 3 and all 43 stored values, and chunks of a few rows.
    wide = Vectors.dense([float(k % 5) for k in range(WIDE + 3)])
    odd = rows.union(rows.sparkSession.createDataFrame([(Vectors.sparse(WIDE + 3, {}), 5.0, 0.0), (wide, 150.0, 1.0), (wide, 90.0, 0.0)], rows.schema))
    monkeypatch.setattr(trees, "CHUNK_VALUES", 90)
    estimator = getattr(trees, name)(labelCol=label, maxIter=3, maxDepth=5, maxBins=64, stepSize=0.3, subsamplingRate=0.8,
                                     featureSubsetStrategy="0.5", minInstancesPerNode=2, seed=7)
    at_once = estimator.fit(odd)
    assert not jobs
    for setting in ("ROUNDS_VALUES", "OPEN_SUMS"):
        monkeypatch.setattr(trees, "ROUNDS_VALUES", small)
        monkeypatch.setattr(trees, setting, 0)
        jobs.clear()
        by_rounds = estimator.fit(odd)
        assert len(jobs) >= 3
        assert by_rounds.totalNumNodes == at_once.totalNumNodes and by_rounds.getNumTrees == at_once.getNumTrees == 3
        assert np.allclose(said(by_rounds, odd), said(at_once, odd), rtol=1e-9)
        assert np.allclose(by_rounds.featureImportances.toArray(), at_once.featureImportances.toArray(), atol=1e-9)


def test_equal_numbers_are_not_split():
    """Sums of equal numbers can leave an impurity below or above zero: the node is a leaf, its gain not that of a cut that isn't allowed."""
    learner = trees.Learner(trees.Bins(np.array([0.5, 0.5]), np.array([0, 2, 4])), 0, 1, 0.0, 2, 7, np.zeros(2, dtype=bool))
    below = 0
    for value in (k / 7 for k in range(1, 200)):
        dense = np.zeros((1, 5, 3))
        for at, rows in ((1, 2), (3, 1), (4, 3)):
            for _ in range(rows):
                dense[0, at] += (1, value, value * value)
        below += trees.impurity(dense[0, 4], False)[1] < 0
        assert [s[2:4] for s in learner.splits([0], [0], dense, 0)] == [(0.0, -1)]
        block = np.array([0, 1, 1], dtype=np.int32), np.array([1, 1, 3], dtype=np.int32), np.array([value] * 3)
        assert trees.Table(learner, [(0, 0, block)]).grown(3, 0, block[2], None)[0].feature == [-1]
    assert below
