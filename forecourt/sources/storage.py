"""Places to write to, and tables written between the steps of a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by spark.checkpoint.dir.

    Only a session whose executors run inside the driver process may fall back to a local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="forecourt-")
    return f"{base.rstrip('/')}/forecourt/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The table written to the shared folder and read back.

    A step that is used several times is computed once, a lost executor costs no more than the step that
    was running, and Spark plans what follows with the true size of the table.
    """
    path = scratch(df.sparkSession, name)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
