"""What keeps the work of queries in proportion to their rows."""

import datetime

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks import queries as q
from forecourt.plans import ladder
from forecourt.sources.storage import scratch


def tables(spark, rows=40):
    """A few line items and parts as the test tables have them."""
    path = scratch(spark, "tables")
    spark.createDataFrame([(i, f"part {i}", f"Brand#{i % 3}", "SMALL", i, 900.0 + i) for i in range(1, 6)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame([(i // 3, i % 5 + 1, 1, i % 3, 10.0, 100.0 * i, 0.0, 0.01 * (i % 5), "N" if i % 4 else "A", "O", datetime.datetime(1994 + i % 6, 3, 1))
                           for i in range(rows)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{path}/lineitem.parquet")
    return path


def test_single_steps_do_not_repeat_the_join(spark):
    path = tables(spark)
    steps = q.clean_step(spark, path)
    assert "Join" not in steps._jdf.queryExecution().optimizedPlan().toString()
    audit = {r.label: r for r in q.cleaning_audit(spark, path).collect()}
    found = {r.label: r for r in steps.collect()}
    assert set(found) == set(audit) and all(r.removed + r.remaining == 40 for r in found.values())
    assert all(found[k].removed >= audit[k].removed for k in audit)


def test_every_record_is_kept_or_set_aside(spark):
    path = tables(spark)
    found = {r.reason: r.records for r in q.scan_quarantine(spark, path).collect()}
    assert sum(found.values()) == 40 and found["too many fields"] == sum(i // 3 % 11 == 0 for i in range(40))


def test_gradient_of_stored_values(spark, monkeypatch):
    vectors = [Vectors.sparse(6, [1, 4], [2.0, -1.0]), Vectors.dense([1.0, 0.0, 3.0, 0.0, 0.0, 0.5]), Vectors.sparse(6, [], [])]
    errors, weights = [0.5, -2.0, 1.0], np.array([0.1, 0.0, 0.0, 9.0, 0.0, 0.0])
    rows = spark.createDataFrame(list(zip(vectors, errors)), ["features", "wrong"])

    def dense(*_):
        raise AssertionError("every value of a vector is met")

    monkeypatch.setattr(q, "vector_to_array", dense)
    want = np.abs(np.array([v.toArray() for v in vectors]).T @ np.array(errors) + 0.2 * weights) / 3
    assert abs(q._gradient(rows, F.col("wrong"), weights, 0.2, 3) - want.max()) < 1e-12


def test_linear_fits_have_larger_tasks(spark, monkeypatch):
    monkeypatch.setattr(ladder, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(ladder, "ROWS_PER_LINEAR_TASK", 100)
    cores = spark.sparkContext.defaultParallelism
    parts = lambda n, estimator: ladder.dealt(spark.range(0, n, 1, 64), estimator).rdd.getNumPartitions()
    assert parts(2000, ladder.tree_regressor()) == 64
    assert parts(2000, ladder.Ridge()) == max(20, cores) and parts(300, ladder.RidgeLogistic()) == min(30, max(3, cores))
    assert parts(5, ladder.Ridge()) == 1
