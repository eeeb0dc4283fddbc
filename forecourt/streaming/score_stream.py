"""Scoring of requests as they arrive, with the same functions as the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from forecourt.config import Scope
from forecourt.operators.features import split_requests
from forecourt.plans.scoring import Valuer, score_listings


def read_requests(spark: SparkSession, path: str, schema, files_per_trigger: int = 8, fmt: str = "parquet") -> DataFrame:
    """Requests from files that keep arriving in a folder."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def _appended(rows: DataFrame, out: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()
    )


def score_stream(requests: DataFrame, valuer: Valuer, scope: Scope, out: str, rejects: str, checkpoint: str,
                 trigger: dict | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """Starts a query that appends scored requests to `out` and one that appends those out of bounds, with their
    reasons, to `rejects`: every request arrives in one of them. Unknown powers are looked up in the table saved with
    the model; a micro-batch reads that and no listing.

    Rows are scored one by one, so the queries keep no state; each one's checkpoint remembers the files that were
    read and the sink's log the files that were written, so a restart neither drops nor repeats a request.
    """
    valid, wrong = split_requests(requests, scope)
    return (_appended(score_listings(valid, valuer, scope), out, f"{checkpoint}/scored", trigger),
            _appended(wrong, rejects, f"{checkpoint}/rejects", trigger))
