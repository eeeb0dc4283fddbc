"""Profiles of loads beside one pass over everything, and filled values beside pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from forecourt.operators import arriving
from forecourt.plans.impute import MissingValues, MissingValuesModel
from forecourt.sources.storage import scratch


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(8)
    n = 30_000
    price = np.where(rng.random(n) < 0.1, np.nan, rng.lognormal(9, 1, n).round(2))
    return pd.DataFrame({"part": rng.choice(4, n, p=[0.7, 0.2, 0.09, 0.01]), "price": price, "year": rng.integers(2000, 2020, n).astype(float),
                         "model": [f"m{k}" for k in rng.zipf(1.5, n) % 5000], "never": np.nan})


@pytest.fixture(scope="module")
def rows(spark, frame):
    df = spark.createDataFrame(frame, "part long, price double, year double, model string, never double").repartition(5)
    return df.withColumn("model", F.when(F.col("model") != "m7", F.col("model")))


COLUMNS = ["price", "year", "model", "never"]


def test_merged_loads_are_one_pass(spark, rows, frame):
    path = scratch(spark, "loads")
    for k in range(4):
        arriving.add_load(rows.where(F.col("part") == k), f"load{k}", path, COLUMNS)
    arriving.add_load(rows.where("part = 2"), "load2", path, COLUMNS)  # arrives again
    merged = {r.column_name: r for r in arriving.merged_profile(arriving.loads(spark, path)).collect()}
    one = {r.column_name: r for r in arriving.merged_profile(arriving.load_profile(rows, "all", COLUMNS)).collect()}
    assert merged["price"].loads == 4 and set(merged) == set(COLUMNS)
    for c in COLUMNS:
        a, b = merged[c], one[c]
        assert (a.rows, a.missing, a.n, a.min, a.max) == (b.rows, b.missing, b.n, b.min, b.max)
        known = frame[c][frame[c] != "m7"].dropna()
        assert a.n == len(known) and a.missing == len(frame) - len(known)
        if c in ("price", "year"):
            assert a.mean == pytest.approx(known.mean(), rel=1e-12) and a.std == pytest.approx(known.std(), rel=1e-12)
            for share, q in zip((0.25, 0.5, 0.75), a.quantiles):
                assert (known < q).mean() - arriving.RANK_ERROR <= share <= (known <= q).mean() + arriving.RANK_ERROR
        else:
            assert a.mean is None and a.std is None and a.quantiles is None
        assert abs(a.different - known.nunique()) <= arriving.DISTINCT_ERROR * known.nunique()


def test_a_load_without_rows(spark, rows):
    path = scratch(spark, "loads")
    arriving.add_load(rows.where("part < 0"), "none", path, COLUMNS)
    empty = {r.column_name: r for r in arriving.merged_profile(arriving.loads(spark, path)).collect()}
    assert all((r.rows, r.n, r.mean, r.quantiles, r.different) == (0, 0, None, None, 0) for r in empty.values())
    arriving.add_load(rows, "some", path, COLUMNS)
    both = {r.column_name: r for r in arriving.merged_profile(arriving.loads(spark, path)).collect()}
    assert both["year"].rows == rows.count() and both["year"].mean is not None


def test_missing_values_are_filled_from_the_fitted_rows(spark, rows, frame):
    train = rows.where("part = 0")
    fitted = Pipeline(stages=[MissingValues(inputCols=["price", "year", "never"], textCols=["model"])]).fit(train)
    seen = frame[frame.part == 0]
    counts = seen.model[seen.model != "m7"].value_counts()
    mode = min(counts[counts == counts.max()].index)
    values = fitted.stages[0].by_column()
    assert values == {"price": seen.price.median(), "year": seen.year.median(), "model": mode}
    path = scratch(spark, "filled")
    fitted.write().save(path)
    loaded = PipelineModel.load(path)
    assert isinstance(loaded.stages[0], MissingValuesModel) and loaded.stages[0].by_column() == values
    filled = loaded.transform(rows)
    assert filled.columns == rows.columns and filled.where("price IS NULL OR year IS NULL OR model IS NULL").count() == 0
    assert filled.where("NOT isnan(never)").count() == 0
    kept = filled.where(F.col("price") != values["price"]).agg(F.sum("price")).first()[0]
    assert kept == pytest.approx(frame.price[frame.price.notna() & (frame.price != values["price"])].sum(), rel=1e-12)


def test_ties_of_texts_go_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,)], "t string")
    assert MissingValues(textCols=["t"]).fit(df).by_column() == {"t": "a"}
    assert MissingValues(textCols=["t"]).fit(df.limit(0)).transform(df).where("t IS NULL").count() == 1
