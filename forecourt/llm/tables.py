"""What the operators of this folder share: their view of a table of documents."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns that count, by fixed names: other columns, whatever their names, play no part."""
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def appended(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with columns set at its end."""
    names = [n for n in batch.schema.names if n not in columns]
    arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*arrays, *columns.values()], names=[*names, *columns])


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the strings of a column take about `most` bytes together, or one row."""
    for batch in batches:
        sizes = [len(x) if x else 0 for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


#: Rows of ids, of eight bytes each, up to which they go to every executor: 16 MB.
FEW_IDS = 2_000_000


def among(df: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    """Rows of `df` whose key occurs in a written table of distinct keys: broadcast if it is counted as small, else
    joined by shuffle."""
    return df.join(F.broadcast(ids) if ids.count() <= FEW_IDS else ids, on, "left_semi")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, unless it is already on their path.

    A cluster whose nodes do not share that folder installs the package or gets it by --py-files.
    """
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
