"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from plumbline.errors import ConfigError

# Settings that belong to the library's semantics rather than to a cluster's size.
_SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on (UTC time, adaptive plans)."""
    for name, value in _SEMANTIC_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: str = "8", app: str = "plumbline") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder the cluster shares between its machines.

    The folder is the session's ``spark.checkpoint.dir``, or the checkpoint folder already
    set on the context.  Only where neither is set and the session runs on this one machine
    is a local folder made; a cluster without the setting is refused.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ConfigError("spark.checkpoint.dir must name a shared folder on a cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="plumbline-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: later steps scan the table again instead of computing it again, and
    a lost executor costs one part of a scan.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
