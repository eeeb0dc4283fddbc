"""A table of runs: every fit with its settings, its metrics, its time and the place of what it made.

A run is a row that is written when it ends, under a key of its own. A search or a ladder that starts again, after the
driver was lost or in another query, finds the rows that exist and does the rest.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

SCHEMA = ("run string, task string, model string, draw int, fold int, settings string, metrics map<string, double>, "
          "seconds double, path string")


def settings_text(settings: dict) -> str:
    """Settings as JSON with sorted names: equal settings are equal texts."""
    return json.dumps(settings, sort_keys=True)


def settings_of(estimator, extra: dict | None = None) -> dict:
    """What was set on an estimator, column names left out, and what a search sets on top."""
    said = {p.name: v for p, v in {**estimator._defaultParamMap, **estimator._paramMap, **(extra or {})}.items()
            if not p.name.endswith("Col")}
    return {k: v for k, v in said.items() if isinstance(v, (bool, int, float, str))}


@dataclass(frozen=True)
class Registry:
    """The runs over one training table, in a folder of the shared file system."""

    spark: SparkSession
    folder: str

    def rows(self) -> DataFrame:
        """All runs that ended. A run that was cut off left no file that counts."""
        self.spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(f"{self.folder}/none")
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(self.folder)

    def of(self, run: str) -> DataFrame:
        return self.rows().where(F.col("run") == run)

    def add(self, run: str, task: str, model: str, settings: dict, metrics: dict, seconds: float, draw: int = -1,
            fold: int = -1, path: str | None = None) -> None:
        """Writes a run. The folder is named by the key, so that runs may end at the same time and a repeated run
        replaces the earlier row."""
        row = (run, task, model, draw, fold, settings_text(settings), {k: float(v) for k, v in metrics.items() if v is not None},
               float(seconds), path)
        place = f"{self.folder}/run={run}/{task}-{model}-{draw}-{fold}"
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").parquet(place)

    def ended(self, run: str) -> dict[tuple[str, str, int, int], Row]:
        """The runs of a name by task, model, draw and fold."""
        return {(r.task, r.model, r.draw, r.fold): r for r in self.of(run).collect()}

    def once(self, run: str, task: str, model: str, settings: dict, make: Callable[[], tuple[dict, float, str | None]]) -> Row:
        """The run of this name, task and model with these settings: the one that ended, or a new one by `make`."""
        held = self.ended(run).get((task, model, -1, -1))
        if held is None or held.settings != settings_text(settings):
            metrics, seconds, path = make()
            self.add(run, task, model, settings, metrics, seconds, path=path)
            held = self.ended(run)[task, model, -1, -1]
        return held
