"""The run ledger: runs, metrics, params and text artifacts as append-only tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.errors import ConfigError
from plumbline.sources.commits import CommitLog

TABLES = {
    "runs": "run_id string, experiment string, stage string, status string",
    "run_metrics": "run_id string, experiment string, stage string, name string, value double",
    "run_params": "run_id string, experiment string, stage string, name string, value string",
    "run_artifacts": "run_id string, experiment string, stage string, name string, text string",
}
# Fixed value: tuned parameters are told apart from given ones by this prefix.
BEST_PREFIX = "best_"
# End of fixed value.
DEFAULT_EXPERIMENT = "default"


class RunLedger:
    """Tables under one folder, partitioned by experiment.

    A row is named by its experiment, run, stage and, for pairs, name.  Every append first
    drops the rows already stored under that name, so that a repeated attempt changes
    nothing and a later stage of a known run is kept.  Appends are commits, so writers that run
    at the same time neither lose nor repeat rows, and readers see whole appends.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _commits(self, table: str) -> CommitLog:
        if table not in TABLES:
            raise ConfigError(f"no ledger table {table!r}; known: {sorted(TABLES)}")
        return CommitLog(self.spark, f"{self.root}/{table}", TABLES[table], ["experiment"])

    def read(self, table: str) -> DataFrame:
        return self._commits(table).read()

    def append(self, table: str, rows: DataFrame) -> None:
        """Add the rows that the table does not hold yet, by their full name.

        A run with many rows is no hot key: the name of the pair is part of the join key.
        """
        names = [c.split()[0] for c in TABLES[table].split(", ")] if table in TABLES else []
        key = [c for c in names if c in ("experiment", "run_id", "stage", "name")]
        self._commits(table).append_new(rows.select(*names), key)

    def _pairs(self, table: str, run_id: str, experiment: str, stage: str, pairs: Mapping):
        rows = [(run_id, experiment, stage, k, v) for k, v in sorted(pairs.items())]
        return self.spark.createDataFrame(rows, TABLES[table])

    def _log(self, run_id, experiment, stage, metrics, params, artifacts, status="FINISHED"):
        run_id = run_id or uuid.uuid4().hex
        experiment = (experiment or "").strip() or DEFAULT_EXPERIMENT
        numbers = {k: float(v) for k, v in metrics.items()}
        texts = {k: str(v) for k, v in params.items()}
        # The run itself is written last: a run that is listed is complete.
        for table, pairs in (("run_metrics", numbers), ("run_params", texts), ("run_artifacts", artifacts)):
            if pairs:
                self.append(table, self._pairs(table, run_id, experiment, stage, pairs))
        run = self.spark.createDataFrame([(run_id, experiment, stage, status)], TABLES["runs"])
        self.append("runs", run)
        return run_id

    def log_evaluation(
        self, run_id: str | None, metrics: Mapping, experiment: str | None = None
    ) -> str:
        """Record the held-out metrics of one evaluation; without a name it is a fresh run."""
        return self._log(run_id, experiment, "evaluate", metrics, {}, {})

    def log_training_run(
        self,
        run_id: str | None,
        *,
        params: Mapping,
        best_params: Mapping,
        metrics: Mapping,
        artifacts: Mapping[str, str] | None = None,
        experiment: str | None = None,
    ) -> str:
        """Record one training run; tuned parameters are stored as ``best_<name>``."""
        tuned = {BEST_PREFIX + k: v for k, v in best_params.items()}
        return self._log(run_id, experiment, "train", metrics, {**params, **tuned}, dict(artifacts or {}))

    def newest_metric(self, name: str) -> DataFrame:
        """Values of one metric over all runs of all experiments."""
        return self.read("run_metrics").where(F.col("name") == name)
