"""What the operators on vectors share: valid rows, and runs of sorted rows packed into one row each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(odd, F.lit(True))


def one_length(rows: DataFrame, vector: str = "vector") -> DataFrame:
    """Rows whose vector has the length that most vectors have, the smaller length on a tie."""
    usual = rows.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n")).agg(F.max_by("d", F.struct("n", -F.col("d")))).scalar()
    return rows.where(F.size(vector) == usual)


def partitions(rows: int, block: int, spark: SparkSession) -> int:
    """Into how many ranges sorted rows are dealt: sixteen blocks each, but a block each while cores would stay idle."""
    return max(1, -(-rows // (16 * block)), min(-(-rows // block), 2 * spark.sparkContext.defaultParallelism))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix of doubles."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(vectors), -1) if len(vectors) else np.empty((0, 0))


def runs(batches: Iterator[pa.RecordBatch], by: list[str], most: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in the columns `by`, at most `most` of them at a time."""
    held: pa.Table | None = None
    for batch in batches:
        held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        keys = np.stack([held.column(c).to_numpy() for c in by])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), held.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            last = end == held.num_rows
            while end - start > most or (not last and start < end):
                yield held.slice(start, min(most, end - start))
                start = min(start + most, end)
            if last:
                held = held.slice(start).combine_chunks()
    if held is not None and held.num_rows:
        yield held
