"""Lookups, explanations, similar listings and comparisons against plain pandas."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import queries as q
from forecourt.config import Scope
from forecourt.operators import similar as s
from forecourt.operators.compare import compare_pairs
from forecourt.operators.explain import explain_listing
from forecourt.operators.features import build_input_row, input_bounds, split_requests, with_midpoint
from forecourt.operators.lookups import brand_context, brand_model_options, fuel_options, impute_power, power_medians

SAMPLE = "listing_id string, brand string, model string, fuel_type string, year double, power_ps double, " \
         "mileage_in_km double, price_in_euro double"


@pytest.fixture(scope="module")
def known():
    """A model with a third of all rows, most of them copies; models of 2 to 6 rows; few-row brands."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(200):
        rows.append(("hot", "hot one", "Petrol", 2010.0, 100.0, 50000.0, 9000.0) if i < 140 else
                    ("hot", "hot one", "Diesel", float(rng.integers(2000, 2023)), float(rng.integers(50, 300)),
                     float(rng.integers(1, 200) * 1000), float(rng.integers(1000, 40000))))
    for m, size in enumerate([2, 3, 4, 5, 6, 40, 60]):
        for _ in range(size):
            rows.append((f"b{m % 3}", f"b{m % 3} m{m}", str(rng.choice(["Petrol", "Diesel Hybrid", "Electric"])),
                         float(rng.integers(2000, 2023)), float(rng.integers(50, 300)),
                         float(rng.integers(1, 200) * 1000), float(rng.integers(1000, 80000))))
    for i in range(9):
        rows.append(("nine", "nine x", "Petrol", 2015.0, 90.0, 1000.0 * (i + 1), 70000.0))
    return pd.DataFrame([(f"{i:04d}", *r) for i, r in enumerate(rows)], columns=[c.split()[0] for c in SAMPLE.split(", ")])


@pytest.fixture(scope="module")
def sample(spark, known):
    return spark.createDataFrame(known, SAMPLE).repartition(4)


def test_options(sample, known):
    got = {r["brand"]: r["models"] for r in brand_model_options(sample).collect()}
    assert got == {b: sorted(set(p["model"])) for b, p in known.groupby("brand")}


def test_power_comes_from_the_narrowest_group(spark, sample, known):
    asked = [("hot", "hot one", "Petrol"), ("b0", "b0 m0", "Petrol"), ("b1", "b1 m1", "Electric"), ("b2", "new", "LPG"),
             ("new", "new", "LPG"), ("b0", "b0 m3", "Petrol"), (None, "b0 m3", "Petrol")]
    df = spark.createDataFrame([(i, *a, None) for i, a in enumerate(asked)],
                               "request_id int, brand string, model string, fuel_type string, power_ps double")

    def want(b, m, f):
        for mask in ((known.brand == b) & (known.model == m) & (known.fuel_type == f),
                     (known.brand == b) & (known.model == m), known.brand == b):
            if mask.sum() >= 3:
                return known[mask].power_ps.median()
        return known.power_ps.median()

    got = {r["request_id"]: r["power_ps"] for r in impute_power(df, power_medians(sample), Scope()).collect()}
    assert got == {i: want(*a) for i, a in enumerate(asked)}
    nothing = impute_power(df, power_medians(sample.limit(0)), Scope()).collect()
    assert {(r["power_ps"], r["power_from"]) for r in nothing} == {(150.0, "default")}


def test_fuels(spark, sample, known):
    df = spark.createDataFrame([(0, "b0", "b0 m6"), (1, "b0", "unseen"), (2, "unseen", "unseen")],
                               "request_id int, brand string, model string")
    got = {r["request_id"]: r["fuels"] for r in fuel_options(df, sample, Scope()).collect()}
    assert got[0] == sorted(set(known[known.model == "b0 m6"].fuel_type))
    assert got[1] == sorted(set(known[known.brand == "b0"].fuel_type)) and got[2] == list(Scope().fuels)
    blank = sample.withColumn("fuel_type", F.lit(None).cast("string"))
    assert fuel_options(df.limit(1), blank, Scope()).first()["fuels"] == list(Scope().fuels)


def test_brands_need_ten_rows(sample):
    standing = {r["brand"]: r["standing"] for r in brand_context(sample).collect()}
    assert standing["nine"] is None  # nine rows, however dear


def requests(spark):
    brands = [("hot", "hot one"), ("b0", "b0 m0"), ("b2", "b2 m2"), ("b0", "b0 m3"), ("b1", "b1 m4"), ("nine", "nine x"),
              ("unseen", "unseen")]
    rows = []
    for (b, m), (first, last), km in itertools.product(
            brands, [(2000, 2023), (2010, 2010), (2015, 2018), (2023, 2023)], [0.0, 1000.0, 50000.0, 50000.0, 180000.0]):
        rows.append((len(rows), b, m, first, last, 100.0 + len(rows) % 50, km))
    schema = "request_id int, brand string, model string, min_year int, max_year int, power_ps double, mileage_in_km double"
    return rows, with_midpoint(spark.createDataFrame(rows, schema).repartition(3))


def nearest(known, brand, model, first, last, power, km, n=8):
    year = (first + last) // 2
    inside = known[(known.mileage_in_km <= km) & known.year.between(first, last)]
    if len(inside) < 5:
        inside = known[known.mileage_in_km <= km]
    if len(inside) < 5:
        inside = known
    found = inside[inside.model == model]
    if len(found) < 5:
        found = inside[inside.brand == brand]
    if len(found) < 5:
        found = inside
    scale = lambda c: max(inside[c].std(), 1.0)
    score = ((found.mileage_in_km - km).abs() / scale("mileage_in_km") + (found.year - year).abs() / scale("year")
             + (found.power_ps - power).abs() / scale("power_ps"))
    # Rounded, because sums of squares and pandas do not agree on the last digit of a scale.
    return sorted(zip(score.round(9), found.listing_id))[:n]


def test_similar_listings_equal_brute_force(spark, sample, known):
    rows, df = requests(spark)
    got = s.similar_listings(df, sample).toPandas()
    for rid, *rest in rows:
        mine = got[got.request_id == rid].sort_values("rank")
        want = nearest(known, *rest)
        assert np.allclose(mine["score"], [w[0] for w in want], atol=1e-8)
        assert list(mine["listing_id"]) == [w[1] for w in want], rid


def test_similar_with_small_and_large_cells(spark, sample, monkeypatch):
    _, df = requests(spark)
    pick = lambda: sorted((r["request_id"], r["rank"], r["listing_id"])
                          for r in s.similar_listings(df, sample).collect())
    whole = pick()
    for leaf in (1, 7, 100_000):
        monkeypatch.setattr(s, "LEAF", leaf)
        assert whole == pick(), leaf


def test_cells_divide_the_listings(spark, monkeypatch):
    """Every listing lies in one leaf of each of its groups, within that leaf's ends; only copies fill a large one."""
    rng = np.random.default_rng(2)
    rows = [(f"{i:05d}", "a", "a one" if i % 3 else "a two", float(rng.integers(2000, 2020)), 100.0, float(rng.exponential(50000))) for i in range(700)]
    rows += [(f"x{i:04d}", "a", "a one", 2010.0, 100.0, 5.0) for i in range(60)]
    df = spark.createDataFrame(rows, "listing_id string, brand string, model string, year double, power_ps double, mileage_in_km double")
    levels = s._tree(s._groups(df), 10)
    leaves = [rows.join(cells.where("leaf"), list(s.PLACE)) for rows, cells in levels]
    held = leaves[0].unionByName(leaves[1]).toPandas()
    for rest in leaves[2:]:
        held = pd.concat([held, rest.toPandas()])
    assert len(held) == 3 * len(rows) == len(held[["kind", "name", "listing_id"]].drop_duplicates())
    for c in s.DIMS:
        assert ((held[c] >= held[f"lo_{c}"]) & (held[c] <= held[f"hi_{c}"])).all()
    sizes = held.groupby(["kind", "name", "cell"]).size()
    assert (sizes == held.groupby(["kind", "name", "cell"])["rows"].first()).all()
    assert len(sizes[sizes > 10]) == 3 and sizes.max() == 60 and len(levels) > 3  # the copies, in model, brand and all


def test_a_request_meets_as_many_listings_in_a_large_table(spark):
    rng = np.random.default_rng(3)

    def met(n):
        rows = [(f"{i:06d}", "a", "a one", float(y), float(p), float(k)) for i, (y, p, k) in enumerate(
            zip(rng.uniform(2000, 2020, n), rng.uniform(50, 300, n), rng.uniform(0, 200000, n)))]
        df = spark.createDataFrame(rows, "listing_id string, brand string, model string, year double, power_ps double, mileage_in_km double")
        asked = spark.createDataFrame([(i, "a", "a one", 2004 + i, 2000, 2019, 60.0 + 20 * i, 150000.0) for i in range(10)],
                                      "request_id int, brand string, model string, year int, min_year int, max_year int, power_ps double, mileage_in_km double")
        return s.met_listings(asked, df).count() / 10

    assert met(64_000) < 1.5 * met(8_000) < 1_500


def test_cells_are_made_of_numbers_without_keys(spark, sample, known, monkeypatch):
    """Every level of the tree is written: it holds different numbers once, however many listings have them."""
    kept, write = [], s.written
    monkeypatch.setattr(s, "written", lambda df, name, *rest: kept.append((name, write(df, name, *rest))) or kept[-1][1])
    _, df = requests(spark)
    s.similar_listings(df, sample).count()
    levels = [rows for name, rows in kept if name == "rows"]
    assert levels and not any("listing_id" in rows.columns for rows in levels)
    every = levels[0].where("kind = 'all'")
    assert every.count() == len(known[list(s.DIMS)].drop_duplicates()) and every.agg(F.max("held")).first()[0] == 8


@pytest.mark.parametrize("query", [q.explain, q.similar])
def test_listings_are_cleaned_once(spark, sample, monkeypatch, query):
    """The medians of power come from the listings that the query has written, not from the raw rows again."""
    asked, read = requests(spark)[1].withColumns({"fuel_type": F.lit("Petrol"), "power_ps": F.lit(None).cast("double")}), []
    monkeypatch.setattr(q.t, "clean", lambda *_: read.append(1) or sample)
    monkeypatch.setattr(q.t, "requests", lambda *_: asked.drop("year"))
    assert query(spark, "").count() > 0 and len(read) == 1


def test_explanations(spark, known, sample):
    rows = [(0, "hot", 1000.0, 2022, 299.0, "Electric"), (1, "nine", 400000.0, 2000, 51.0, "Diesel Hybrid")]
    df = spark.createDataFrame(rows, "request_id int, brand string, mileage_in_km double, year int, power_ps double, "
                                     "fuel_type string")
    got = {r["request_id"]: r for r in explain_listing(df, sample, Scope()).collect()}
    assert got[0]["reasons"][:3] == ["mileage_low", "age_newer", "power_high"] and got[0]["reasons"][-1] == "fuel_electric"
    assert got[1]["reasons"] == ["mileage_high", "age_older", "power_low", "fuel_hybrid"]
    assert all(len(r["reasons"]) == len(r["sentences"]) <= 5 for r in got.values())


def test_bounds_and_features(spark):
    rows = [(0, 2000, 2023, 41.0, 1.0), (1, 1999, 2010, 100.0, 5.0), (2, 2010, 2005, 100.0, 5.0),
            (3, 2010, 2015, 40.0, 5.0), (4, 2010, 2015, None, 500001.0), (5, 2022, 2023, None, 0.0), (6, 2023, 2023, 799.0, 9.0)]
    df = spark.createDataFrame(rows, "request_id int, min_year int, max_year int, power_ps double, mileage_in_km double")
    for c in ("brand", "model", "fuel_type", "transmission_type"):
        df = df.withColumn(c, F.lit("x"))
    got = {r["request_id"]: r["rejected_for"] for r in input_bounds(df, Scope()).collect()}
    assert got == {0: "", 1: "year", 2: "year", 3: "power", 4: "mileage", 5: "mileage", 6: ""}
    good, bad = split_requests(df, Scope())
    assert good.count() == 2 and bad.count() == 5
    made = {r["request_id"]: r for r in build_input_row(df, Scope()).collect()}
    assert made[6]["car_age"] == 0 and made[6]["mileage_per_year"] == 9  # age 0 counts as 1
    assert made[0]["car_age"] == 12  # the midpoint 2011


def test_display(spark):
    row = [("mercedes-benz", "C 180", 2015.0, 1234.9, "Petrol", "Manual", 156.0, 19486.5),
           ("o'neil 3x", "T", 2000.0, 1.0, "Petrol", "Manual", 80.0, 500.0)]
    df = spark.createDataFrame(row, "brand string, model string, year double, mileage_in_km double, fuel_type string, "
                                    "transmission_type string, power_ps double, price_in_euro double")
    got = {r["Model"]: r for r in s.display_labels(df).collect()}
    assert got["C 180"]["Brand"] == "Mercedes Benz" and got["T"]["Brand"] == "o'neil 3x".title()
    assert got["C 180"]["Price (€)"] == f"€{19486.5:,.0f}" and got["C 180"]["Mileage (km)"] == 1234


def test_comparison(spark):
    scored = spark.createDataFrame([(1, 10000.0, "LOW", 0.9), (2, 12000.0, "HIGH", 0.8), (3, 10000.5, "LOW", 0.7),
                                    (4, -5.0, "LOW", 0.6)],
                                   "request_id int, price double, segment string, confidence double")
    pairs = spark.createDataFrame([(0, 1, 2), (1, 2, 1), (2, 1, 3), (3, 4, 1)], "pair_id int, request_a int, request_b int")
    got = {r["pair_id"]: r for r in compare_pairs(pairs, scored).collect()}
    assert [got[i]["verdict"] for i in range(4)] == ["b dearer", "a dearer", "same", "b dearer"]
    assert got[0]["difference_pct"] == 20 and got[3]["difference_pct"] == 0
