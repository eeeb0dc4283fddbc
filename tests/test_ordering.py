"""Ranks, running totals and quantiles against pandas, with a third of the rows in one group."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from forecourt.operators.ordering import (
    balanced_cuts, group_quantiles, hash_rank, overall_median, running_totals, with_range,
)
from forecourt.operators.profiling import adjusted_skewness, correlation_matrix, histogram, numeric_summary
from forecourt.operators.splitting import fold_assign, sample_rows, stratified_split, train_test_split


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 3000
    return pd.DataFrame({
        "id": [f"{i:05d}" for i in range(n)],
        "g": np.where(rng.random(n) < 0.35, "hot", rng.choice(list("abcdefg"), n)),
        # A third of the values are one and the same.
        "x": np.where(rng.random(n) < 0.33, 5.0, np.round(rng.lognormal(3, 2, n), 2)),
        "y": rng.normal(size=n),
    })


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame).repartition(5)


def test_group_quantiles(df, frame):
    got = group_quantiles(df, ["g"], "x", [0.25, 0.5, 0.9]).collect()
    want = frame.groupby("g")["x"]
    for r in got:
        assert r["quantile"] == pytest.approx(want.quantile(r["share"])[r["g"]], rel=1e-12)
        assert r["n"] == want.size()[r["g"]]
    assert len(got) == 3 * frame["g"].nunique()


def test_quantiles_do_not_depend_on_brackets_or_partitions(spark, monkeypatch):
    """With a coarse sketch the brackets are narrow and most rows are only counted: not a bit may change."""
    rng = np.random.default_rng(3)
    values = np.where(rng.random(20_000) < 0.3, 7.25, rng.lognormal(3, 2, 20_000))
    df = spark.createDataFrame(pd.DataFrame({"g": rng.choice(list("aab"), 20_000), "x": values}))
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]

    def found(parts):
        some = df.repartition(parts)
        rows = group_quantiles(some, ["g"], "x", shares).collect() + group_quantiles(some, [], "x", shares).collect()
        return sorted(tuple(r) for r in rows if len(r) == 4), sorted(tuple(r) for r in rows if len(r) == 3)

    wide = found(1)
    monkeypatch.setattr("forecourt.operators.ordering.ACCURACY", 200)
    assert found(1) == wide and found(7) == wide
    assert [q for _, _, q in wide[1]] == pytest.approx(list(np.quantile(values, shares)), rel=1e-13)


def test_rows_of_a_group_do_not_meet_in_one_task(spark, monkeypatch):
    """Large groups have a bracket, small ones none: neither kind of row is shuffled or sorted by its group."""
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"g": rng.choice(list("aaaab"), 5_000), "h": 1, "x": rng.lognormal(3, 2, 5_000)})
    frame.loc[:9, "g"] = "few"
    monkeypatch.setattr("forecourt.operators.ordering.ACCURACY", 300)
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        before = spark.conf.get(name)
        spark.conf.set(name, value)
        try:
            got = group_quantiles(spark.createDataFrame(frame), ["g", "h"], "x", [0.1, 0.5])
            plan = got._jdf.queryExecution().executedPlan().toString()
            rows = got.collect()
        finally:
            spark.conf.set(name, before)
        assert "SortMergeJoin" not in plan
        assert sorted((r["g"], r["share"], r["n"]) for r in rows) == sorted(
            (g, s, n) for g, n in frame["g"].value_counts().items() for s in (0.1, 0.5))
        for r in rows:
            assert r["quantile"] == pytest.approx(frame[frame["g"] == r["g"]]["x"].quantile(r["share"]), rel=1e-12)


def test_missing_keys_and_values_are_left_out(spark):
    data = [("a", 1.0), ("a", 2.0), ("a", None), (None, 9.0), ("b", None)]
    got = group_quantiles(spark.createDataFrame(data, "g string, x double"), ["g"], "x", [0.5]).collect()
    assert [(r["g"], r["n"], r["quantile"]) for r in got] == [("a", 2, 1.5)]
    empty = spark.createDataFrame([], "x double")
    assert group_quantiles(empty, [], "x", [0.5]).count() == 0
    assert spark.range(1).select(overall_median(empty, "x").alias("m")).first()["m"] is None


def test_running_totals(df, frame):
    merged = df.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    got = running_totals(with_range(merged, "x", balanced_cuts(merged, ["x"], 16)[0]), ["g"], "x", ["n"]).toPandas()
    for g, part in got.groupby("g"):
        part = part.sort_values("x")
        assert (part["n"].cumsum() == part["n_run"]).all()
        assert part["n_run"].iloc[-1] == (frame["g"] == g).sum()


def test_hash_rank_counts_every_row_once(df, frame):
    ranked = hash_rank(df.withColumn("h", F.md5("id")), ["g"], "h", "id").toPandas()
    for _, part in ranked.groupby("g"):
        assert list(part.sort_values(["h", "id"])["rank"]) == list(range(1, len(part) + 1))


def test_splits_do_not_depend_on_partitioning(df, frame):
    for make in (lambda x: train_test_split(x, "id"), lambda x: stratified_split(x, ["g"], "id"),
                 lambda x: fold_assign(x, "id", ["g"]).withColumnRenamed("fold", "split")):
        a = {r["id"]: r["split"] for r in make(df).select("id", "split").collect()}
        b = {r["id"]: r["split"] for r in make(df.repartition(3, "y")).select("id", "split").collect()}
        assert a == b and len(a) == len(frame)


def test_shares_of_splits(df, frame):
    plain = train_test_split(df, "id").filter("split = 'test'").count() / len(frame)
    assert abs(plain - 0.2) < 0.03
    strict = stratified_split(df, ["g"], "id").groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect()
    assert all(r["t"] == r["n"] // 5 for r in strict)
    folds = fold_assign(df, "id", ["g"]).groupBy("g", "fold").count().toPandas().groupby("g")["count"]
    assert ((folds.max() - folds.min()) <= 1).all()


def test_sample(df, frame):
    one = {r["id"] for r in sample_rows(df, 500, "id").collect()}
    two = {r["id"] for r in sample_rows(df.repartition(2), 500, "id").collect()}
    assert len(one) == 500 and one == two
    assert sample_rows(df, 10_000, "id").count() == len(frame)


def test_summary_skew_and_correlation(df, frame):
    got = {r["column_name"]: r for r in numeric_summary(df, ["x", "y"]).collect()}
    for c in "xy":
        want = frame[c].describe()
        for mine, theirs in (("n", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                             ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert got[c][mine] == pytest.approx(want[theirs], rel=1e-9, abs=1e-9)
    skew = df.agg(adjusted_skewness(F.col("x")).alias("s")).first()["s"]
    assert skew == pytest.approx(frame["x"].skew(), rel=1e-9)
    assert df.limit(2).agg(adjusted_skewness(F.col("x")).alias("s")).first()["s"] is None
    r = {(x["column_a"], x["column_b"]): x["r"] for x in correlation_matrix(df, ["x", "y"]).collect()}
    assert r["x", "y"] == pytest.approx(frame["x"].corr(frame["y"]), abs=1e-12) and r["x", "x"] == pytest.approx(1)


@pytest.mark.parametrize("bins", [7, 100])
def test_histogram(df, frame, spark, bins):
    got = histogram(df, F.col("x"), bins).orderBy("bin").toPandas()
    counts, edges = np.histogram(frame["x"], bins=bins)
    assert list(got["n"]) == list(counts)
    assert np.allclose(got["lower"], edges[:-1]) and np.allclose(got["upper"], edges[1:])
    flat = histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), F.col("x"), 4).orderBy("bin").toPandas()
    assert list(flat["n"]) == list(np.histogram([3.0, 3.0], bins=4)[0])
