import random

import pytest
from pyspark.sql import functions as F

from forecourt.llm.tables import importable

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


def rows_of(texts):
    return [(i, t, "en" if i % 2 else None, None, len(t or "")) for i, t in enumerate(texts)]


def prose(seed, n, words=("alpha", "beta", "gamma", "delta", "the", "of", "and", "omega", "sigma", "kappa", "in", "tau", "rho", "chi")):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + str(rng.randrange(40)) if rng.random() < 0.7 else rng.choice(("the", "of", "and", "in")) for _ in range(n))


#: Nulls, empty, white space, signs only, one word, very long, equal and nearly equal texts.
ODD = [None, "", "  \n\t ", "!!! ###\n$$$", "word", "word", prose(1, 30_000), prose(2, 60), prose(2, 60) + " end", prose(2, 60),
       "Éa ñandú\nßtraße 漢字 İstanbul \U0001f600", "x" * 20_000, prose(3, 40) + "\n" + prose(4, 40), prose(4, 40) + "\n" + prose(5, 40)]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts, a repeated row, a row without id, and columns whose names operators use themselves."""
    rows = rows_of(ODD)
    rows += [rows[7], (None, prose(2, 60), "en", "s", 3), (None, None, None, None, None)]
    clash = ("version", "bucket", "id", "key", "kind", "words", "row", "set", "n", "component", "Text2")
    return spark.createDataFrame(rows, DOCS).select("*", *[F.lit(k).alias(c) for k, c in enumerate(clash)])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
