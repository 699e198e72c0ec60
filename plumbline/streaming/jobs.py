"""Running a stream to the end of what is there, and reading what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame


def drain(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Process everything available, then return the rows written to ``path``.

    Progress and output are kept under ``path``; started again it goes on where it ended.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", f"{path}/rows")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows")


def drain_batches(stream: DataFrame, path: str, per_batch, mode: str = "update") -> None:
    """Process everything available with a function per micro-batch."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(per_batch)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
