"""The driver contract: names, a flagship result, and a few queries beside their SQL."""

import importlib.util
import sys

import pytest

import __spark_entry__ as entry
from checks.compare import difference, duck

SMALL = "/root/testdata/sf0.001"
QUICK = ("cleaning_audit", "clean_listings", "numeric_summary", "group_median", "train_threshold", "input_bounds",
         "impute_power", "roc_curve", "fold_assign", "similar_listings",
         "scan_by_name", "scan_quarantine")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", QUICK)
def test_beside_sql(spark, name):
    found = entry.queries()[name](spark, SMALL).toPandas()
    assert difference(found, duck(SMALL).sql(entry.oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("gone", ["corpus_pipeline", "forecourt.llm.queries"])
def test_the_rest_works_without_the_training_data_operators(monkeypatch, gone):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("forecourt.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, gone, None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    alone = importlib.import_module("__spark_entry__")
    assert alone.queries() and not any(n.startswith("op") or n == "pipeline" for n in alone.queries())
    assert set(alone.oracle_sql()) <= set(alone.queries())


def test_other_import_errors_are_not_hidden(monkeypatch):
    monkeypatch.setitem(sys.modules, "forecourt.llm.tables", None)
    for name in ("__spark_entry__", "corpus_pipeline", "forecourt.llm", "forecourt.llm.queries"):
        monkeypatch.delitem(sys.modules, name, raising=False)
    if importlib.util.find_spec("corpus_pipeline"):
        with pytest.raises(ModuleNotFoundError):
            importlib.import_module("__spark_entry__")
