"""Experiment log and model store in plain files: a JSON row for each run, models by name and version, artifacts by run."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import claim, write_csv

SCHEMA = "run_id string, parent_id string, experiment string, name string, started timestamp, params string, metrics string, model string, version string"


class RunLog:
    """Appends to ``path/runs``; the newest run and the highest model version are found by query."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def log(
        self, experiment: str, name: str, params: dict | None = None, metrics: dict | None = None, model: str | None = None, parent: str | None = None, started: datetime | None = None,
        save: Callable[[str], None] | None = None, artifacts: dict[str, DataFrame] | None = None, run: str | None = None,
    ) -> str:
        """Records a finished run and gives its id.

        A named model gets the next version, which no other run can have, and ``save`` writes it to its :meth:`model_path`.
        ``artifacts``, tables of bounded size, are kept as CSV. The run is recorded last: what it names is there.
        """
        run = run or uuid.uuid4().hex
        version = None if model is None else self._next_version(model)
        if save and model:
            save(self.model_path(model, version))
        for key, table in (artifacts or {}).items():
            write_csv(table, self.artifact_path(run, key))
        row = (run, parent, experiment, name, started or datetime.now(timezone.utc).replace(tzinfo=None), json.dumps(params or {}), json.dumps(metrics or {}), model, version)
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").json(f"{self.path}/runs")
        return run

    def runs(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).json(f"{self.path}/runs")
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], SCHEMA)
            raise

    def latest(self, experiment: str, name: str | None = None) -> dict:
        """The newest run, its params and metrics as dicts; LookupError if there is none."""
        found = self.runs().filter(F.col("experiment") == experiment)
        if name:
            found = found.filter(F.col("name") == name)
        row = found.orderBy(F.desc("started"), F.desc("run_id")).limit(1).first()
        if row is None:
            raise LookupError(f"no run of {experiment}" + (f" named {name}" if name else ""))
        return row.asDict() | {k: json.loads(row[k]) for k in ("params", "metrics")}

    def latest_version(self, model: str, missing: str | None = None) -> str:
        """The highest version, as a number; LookupError (or ``missing``) if the model has none."""
        v = self.runs().filter(F.col("model") == model).agg(F.max(F.col("version").cast("int"))).first()[0]
        if v is None:
            if missing is not None:
                return missing
            raise LookupError(f"no version of {model}")
        return str(v)

    def _next_version(self, model: str) -> str:
        """The first version above the known ones that this call is first to claim."""
        n = int(self.latest_version(model, missing="0")) + 1
        while not claim(self.spark, f"{self.path}/versions/{model}/{n}"):
            n += 1
        return str(n)

    def artifact_path(self, run: str, key: str) -> str:
        return f"{self.path}/artifacts/{run}/{key}"

    def artifact(self, run: str, key: str) -> DataFrame:
        return self.spark.read.option("header", True).option("inferSchema", True).csv(self.artifact_path(run, key))

    def model_path(self, model: str, version: str) -> str:
        return f"{self.path}/models/{model}/{version}"
