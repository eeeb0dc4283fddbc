"""Dirty rows, one per rule and edge."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from forecourt.config import Scope
from forecourt.operators.cleaning import (
    clean_listings, cleaning_audit, default_rules, drop_columns, first_broken, fuel_rule, remove, transmission_rule,
)
from forecourt.operators.profiling import duplicate_count, null_profile
from forecourt.sources.readers import RAW_COLUMNS, coerce_numeric, scan_listings
from forecourt.sources.sinks import WriteMismatch, write_verified
from forecourt.sources.storage import scratch

BASE = {"brand": "volkswagen", "model": "Volkswagen Golf", "year": "2015", "price_in_euro": "15000", "power_ps": "150",
        "transmission_type": "Manual", "fuel_type": "Petrol", "mileage_in_km": "100000", "color": "red"}
# (changes, number of the rule that removes the row or None)
CASES = [
    ({"price_in_euro": "abc"}, 1), ({"price_in_euro": ""}, 1), ({"price_in_euro": "NaN"}, 1),
    ({"price_in_euro": "1d"}, 1), ({"price_in_euro": "1_000"}, 1), ({"price_in_euro": "0x10"}, 1),
    ({"price_in_euro": "inf"}, 9), ({"price_in_euro": " 1.5e4 "}, None), ({"price_in_euro": "15000."}, None),
    ({"year": "x"}, 2), ({"power_ps": ""}, 3), ({"mileage_in_km": None}, 4), ({"mileage_in_km": "n/a"}, 4),
    ({"fuel_type": "07/2010"}, 5), ({"fuel_type": None}, 5), ({"fuel_type": "petrol"}, 5),
    ({"transmission_type": "Unknown"}, 6), ({"transmission_type": None}, None),
    ({"year": "1999"}, 7), ({"year": "2000"}, None),
    ({"price_in_euro": "499"}, 8), ({"price_in_euro": "500"}, None),
    ({"price_in_euro": "80000"}, None), ({"price_in_euro": "80001"}, 9),
    ({"power_ps": "39"}, 10), ({"power_ps": "40"}, None), ({"power_ps": "800"}, None), ({"power_ps": "801"}, 10),
    ({"mileage_in_km": "500000"}, None), ({"mileage_in_km": "500001"}, 11), ({"mileage_in_km": "0"}, 12),
    ({"year": "1990", "price_in_euro": "100"}, 7),
    ({}, None), ({}, None),
]


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [{**BASE, **change, "case": str(i)} for i, (change, _) in enumerate(CASES)]
    columns = list(rows[0])
    text = spark.createDataFrame([[r[c] for c in columns] for r in rows], ", ".join(f"{c} string" for c in columns))
    path = scratch(spark, "dirty")
    # Only the columns a raw file has are read back, by name and as text.
    text.coalesce(1).write.option("header", True).csv(path)
    return coerce_numeric(scan_listings(spark, path, columns))


def test_each_row_goes_to_the_first_rule_it_breaks(dirty):
    got = {int(r["case"]): r["broken"] for r in
           dirty.select("case", first_broken(default_rules(Scope())).alias("broken")).collect()}
    assert got == {i: rule for i, (_, rule) in enumerate(CASES)}


def test_audit_adds_up(dirty):
    audit = cleaning_audit(dirty, default_rules(Scope())).orderBy("step").collect()
    clean = clean_listings(dirty, default_rules(Scope()))
    assert [r["removed"] for r in audit] == [sum(rule == i for _, rule in CASES) for i in range(1, 13)]
    assert audit[-1]["remaining"] == clean.count() == len(CASES) - sum(r["removed"] for r in audit)
    assert all(a["remaining"] - b["removed"] == b["remaining"] for a, b in zip(audit, audit[1:]))
    assert "color" not in clean.columns
    missing = {r["column_name"]: r["missing"] for r in null_profile(clean).collect()}
    assert sum(n for c, n in missing.items() if c != "transmission_type") == 0


def test_audit_of_nothing(dirty):
    audit = cleaning_audit(dirty.limit(0), default_rules(Scope())).collect()
    assert len(audit) == 12 and all(r["removed"] == r["remaining"] == 0 and r["kept_pct"] is None for r in audit)


def test_single_rules_are_null_safe(dirty):
    assert dirty.filter("fuel_type IS NULL").count() == 1
    assert remove(dirty, fuel_rule(Scope())).filter("fuel_type IS NULL").count() == 0
    assert remove(dirty, transmission_rule(Scope())).filter("transmission_type IS NULL").count() == 1


def test_filters_reach_the_scan(spark, dirty):
    path = scratch(spark, "parquet")
    dirty.write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = clean_listings(spark.read.parquet(path), default_rules(Scope()))._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.rindex("PushedFilters"):]
    for part in ("GreaterThanOrEqual(price_in_euro,500.0)", "In(fuel_type", "IsNotNull(year)"):
        assert part in pushed
    assert "color" not in plan[plan.rindex("ReadSchema"):]


def test_duplicates_and_absent_columns(dirty):
    assert duplicate_count(drop_columns(dirty, ["case", "no such column"])).first()["duplicates"] >= 1


def test_write_is_verified(spark, dirty, monkeypatch):
    clean = clean_listings(dirty, default_rules(Scope()))
    row = write_verified(clean, scratch(spark, "verified"), "csv").first()
    assert row["verified"] and row["expected_rows"] == row["written_rows"] == clean.count()
    # A field that breaks a line changes what a line-based reader finds, and the check notices.
    broken = spark.createDataFrame([("a\nb",)], "x string")
    with pytest.raises(WriteMismatch):
        write_verified(broken, scratch(spark, "broken"), "csv")


def test_missing_file_fails(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_listings(spark, "/tmp/no-such-listings.csv", RAW_COLUMNS)


def test_coercion_matches_pandas(spark):
    values = ["1", "1.5", " 2 ", "-3", "+4", ".5", "5.", "1e3", "1E-2", "abc", "", "1,5", "12 km", "NaN", "--1", "1d", "1f"]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, year string")
    got = [r["year"] for r in coerce_numeric(frame).orderBy("i").collect()]
    want = [None if pd.isna(v) else float(v) for v in pd.to_numeric(pd.Series(values), errors="coerce")]
    assert got == want
    assert frame.filter(F.col("year").isNull()).count() == 0
