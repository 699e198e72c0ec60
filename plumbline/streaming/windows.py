"""Plain window aggregates over a stream of samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(
    samples: DataFrame, width_s: int, keys: Sequence[str], *, delay: str = "1 minute"
) -> DataFrame:
    """Count and largest value per fixed window and key.

    A window is given once the watermark has passed it; samples later than ``delay`` are
    dropped.  Times without a zone must be cast to ``timestamp`` first: a watermark refuses
    them.
    """
    return (
        samples.withWatermark("ts", delay)
        .groupBy(F.window("ts", f"{width_s} seconds").alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("largest"))
        .select(F.col("_w.start").alias("starts"), *keys, "n", "largest")
    )
