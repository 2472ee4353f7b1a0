"""Model registry and run log: saved models, and commits that say what they are."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.sources.commits import CommitLog
from basketlens.sources.layers import FolderLayer

LOG = "commits"
ENTRY = (
    "commit long, kind string, name string, version long, path string, run_id string, experiment string, "
    "run_name string, params map<string, string>, metrics map<string, double>, micros long"
)


def _micros() -> int:
    return time.time_ns() // 1000


@dataclass(frozen=True)
class ModelRegistry:
    """Saved pipeline models by name and version, and runs with params and metrics.

    A model is saved under a path of its own first; a commit then gives it its version, or
    shows its run with all params and metrics. Jobs may register and log at the same time: each
    gets its own version (see ``CommitLog``). A job that ends in between leaves an unused folder.
    """

    layer: FolderLayer

    @property
    def spark(self):
        return self.layer.spark

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.layer.path(LOG))

    def _save(self, model: PipelineModel, group: str) -> str:
        path = f"{self.layer.path('models')}/{group}/{uuid.uuid4().hex}"
        model.write().save(path)
        return path

    def versions(self) -> DataFrame:
        found = self.log.read(ENTRY).filter("kind = 'version'")
        return found.selectExpr("name", "version", "path", "timestamp_micros(micros) AS registered_at")

    def latest(self, name: str) -> DataFrame:
        """The row of the highest version of a model, or no row."""
        return self.versions().filter(F.col("name") == name).orderBy(F.col("version").desc()).limit(1)

    def register(self, name: str, model: PipelineModel) -> int:
        """Save a model as the next version of its name."""
        path, given = self._save(model, name), []

        def entry() -> dict[str, object]:
            last = self.latest(name).first()
            given.append(last["version"] + 1 if last else 1)
            return {"kind": "version", "name": name, "version": given[-1], "path": path, "micros": _micros()}

        self.log.commit(entry)
        return given[-1]

    def load_latest(self, name: str) -> PipelineModel:
        row = self.latest(name).first()
        if row is None:
            raise LookupError(f"no model registered as {name}")
        return PipelineModel.load(row["path"])

    def runs(self) -> DataFrame:
        found = self.log.read(ENTRY).filter("kind = 'run'")
        return found.selectExpr(
            "run_id", "experiment", "run_name", "path AS model_path", "timestamp_micros(micros) AS start_time", "commit"
        )

    def log_run(
        self, experiment: str, run_name: str, params: dict[str, object], metrics: DataFrame, model: PipelineModel | None = None
    ) -> str:
        """Commit a run with its params and its few (metric, value) rows; returns its id."""
        run_id = uuid.uuid4().hex
        run = {
            "kind": "run", "run_id": run_id, "experiment": experiment, "run_name": run_name,
            "path": None if model is None else self._save(model, "runs"),
            "params": {k: str(v) for k, v in params.items()},
            "metrics": {r["metric"]: r["value"] for r in metrics.select("metric", "value").collect()},
            "micros": _micros(),
        }
        self.log.commit(lambda: run)
        return run_id

    def run_values(self, run_id: str) -> DataFrame:
        """A row per param (as text) and per metric (as a number) of a run."""
        run = self.log.read(ENTRY).filter((F.col("kind") == "run") & (F.col("run_id") == run_id))
        params = run.selectExpr("run_id", "'param' AS kind", "explode(params) AS (key, text)", "CAST(NULL AS DOUBLE) AS value")
        numbers = run.selectExpr("run_id", "'metric' AS kind", "explode(metrics) AS (key, value)")
        return params.unionByName(numbers.selectExpr("run_id", "kind", "key", "CAST(NULL AS STRING) AS text", "value"))

    def latest_run(self, experiment: str) -> DataFrame:
        """The row of the last started run of an experiment, or no row."""
        own = self.runs().filter(F.col("experiment") == experiment)
        return own.orderBy(F.col("start_time").desc(), F.col("commit").desc()).limit(1)

    def load_latest_run(self, experiment: str) -> PipelineModel:
        row = self.latest_run(experiment).first()
        if row is None or row["model_path"] is None:
            raise LookupError(f"no run with a model in {experiment}")
        return PipelineModel.load(row["model_path"])
