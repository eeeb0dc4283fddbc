"""Session settings."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: str = "*", memory: str = "8g", shuffles: int = 8, shared: str | None = None) -> SparkSession:
    """A session for tests and benchmarks on one machine; steps are written to the folder `shared`, by default one
    of its own. A cluster brings its own session, which names a folder that all executors share."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("forecourt")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffles))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared or tempfile.mkdtemp(prefix="forecourt-"))
        # Small test tables: keep all cores busy instead of merging partitions up to a megabyte.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.files.openCostInBytes", "64k")
        # Recording the Python line of every column expression costs more than planning a small query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, unless it is already on their path.

    A cluster whose nodes do not share that folder installs the package or gets it by --py-files.
    """
    root, known = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
