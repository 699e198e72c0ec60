"""Last-value gauges: in a stream, and as a small state table kept by a sink."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.columns import STAGES, allow_values

log = logging.getLogger(__name__)

# The two gauges of a stage (a deployment may put a prefix before them).
DURATION_METRIC = "pipeline_stage_duration_seconds"
SUCCESS_METRIC = "pipeline_stage_success"
# End of fixed values.
GAUGE_SCHEMA = "job string, stage string, duration_seconds double, success int, ts timestamp"


def stream_last_values(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest value per key, updated as samples come in (update mode)."""
    return samples.groupBy(*keys).agg(
        F.max_by("value", F.struct("ts", "value")).alias("value"), F.max("ts").alias("ts")
    )


def newest_gauges(pushes: DataFrame) -> DataFrame:
    """The last push per (job, stage); a push replaces both gauges of its group."""
    newest = F.max_by(F.struct("duration_seconds", "success"), F.struct("ts", "success"))
    return (
        pushes.groupBy("job", "stage")
        .agg(newest.alias("g"), F.max("ts").alias("ts"))
        .select("job", "stage", "g.duration_seconds", "g.success", "ts")
    )


def gauge_samples(gauges: DataFrame, prefix: str = "") -> DataFrame:
    """Gauges as metric samples, two per (job, stage)."""
    pair = F.array(
        F.struct(F.lit(prefix + DURATION_METRIC).alias("metric"), F.col("duration_seconds").alias("value")),
        F.struct(F.lit(prefix + SUCCESS_METRIC).alias("metric"), F.col("success").cast("double").alias("value")),
    )
    labels = F.create_map(F.lit("job"), F.col("job"), F.lit("stage"), F.col("stage"))
    return gauges.select(labels.alias("labels"), "ts", F.inline(pair)).select(
        "metric", "labels", "ts", "value"
    )


class GaugeTable:
    """A state table with one row per (job, stage), written in numbered versions.

    A version is complete before it can be seen, and the same batch writes the same
    version, so a batch that runs twice changes nothing.  Pushes are
    reduced to one row per (job, stage) before they meet the table.
    """

    def __init__(self, spark: SparkSession, root: str | None, stages: Sequence[str] = STAGES):
        self.spark, self.root, self.stages = spark, root and root.rstrip("/"), stages

    def _versions(self) -> list[int]:
        """Numbers of the complete versions; two at most, and one that is being written."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName().startswith("version=")]
        done = [f for f in found if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
        return sorted(int(f.getName().split("=")[1]) for f in done)

    def read(self, before: int | None = None) -> DataFrame:
        """The newest version, or the newest one below ``before``."""
        known = [v for v in self._versions() if before is None or v < before]
        if not known:
            return self.spark.createDataFrame([], GAUGE_SCHEMA)
        return self.spark.read.schema(GAUGE_SCHEMA).parquet(f"{self.root}/version={known[-1]}")

    def _write(self, rows: DataFrame, version: int) -> None:
        """Write a version, then remove all but it and the one it was made from."""
        rows.write.mode("overwrite").parquet(f"{self.root}/version={version}")
        for old in self._versions()[:-2]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/version={old}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def upsert(self, pushes: DataFrame, version: int) -> None:
        """Merge pushes into the table.  Unknown stages are refused and logged.

        Without a target nothing happens.  A failure is raised: a stream that goes on after
        one would lose its pushes.
        """
        if not self.root:
            return
        ok, refused = allow_values(pushes, "stage", self.stages)
        names = refused.select("stage").distinct()
        unknown = names.limit(20).collect()
        if unknown:
            log.warning("%d refused stages, e.g. %s", names.count(), [r["stage"] for r in unknown])
        merged = newest_gauges(newest_gauges(ok).unionByName(self.read(before=version)))
        self._write(merged, version)

    def reset(self, job: str, version: int) -> None:
        """Clear a job's gauges, so that a stage that does not run is absent, not stale."""
        if not self.root:
            return
        try:
            self._write(self.read(before=version).where(F.col("job") != job), version)
        except Exception as e:  # noqa: BLE001
            log.warning("gauges not reset: %s", e)

    def sink(self):
        """For ``writeStream.foreachBatch``."""
        return lambda batch, number: self.upsert(batch, number)


def push_stage_metrics(
    table: GaugeTable, job: str, stage: str, duration_seconds: float, success: bool, version: int
) -> None:
    """Put the two gauges of one stage.

    A failure is logged and swallowed: metrics never fail the work they measure.
    """
    rows = table.spark.createDataFrame(
        [(job, stage, float(duration_seconds), int(success))],
        "job string, stage string, duration_seconds double, success int",
    ).withColumn("ts", F.current_timestamp())
    try:
        table.upsert(rows, version)
    except Exception as e:  # noqa: BLE001
        log.warning("gauges not written: %s", e)
