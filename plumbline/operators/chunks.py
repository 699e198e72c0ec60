"""Splitting long ordered groups into time chunks.

A window over one series would put that whole series into one task.  The operators on
ordered data therefore group by (series, chunk).  Rows that a neighbouring chunk must
see are copied there and marked as ghosts, and values that reach further back than one
chunk are carried over through a table with one row per chunk.  Both are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.errors import ConfigError

MICROS = 1_000_000
CHUNK = "_chunk"
GHOST = "_ghost"


def floor_div(value: Column, width: int) -> Column:
    """Whole-number floor division, right for negative values too (no float rounding)."""
    w = F.lit(width).cast("bigint")
    return F.call_function("div", value - F.pmod(value, w), w)


def ceil_div(value: Column, width: int) -> Column:
    return -floor_div(-value, width)


def chunk_width(reach_us: int, wanted_us: int | None = None) -> int:
    """Chunk length; at least eight reaches, so that few rows are copied."""
    return max(wanted_us or 0, 8 * reach_us, MICROS)


def with_chunks(
    df: DataFrame, us: str, width_us: int, *, ahead_us: int = 0, back_us: int = 0
) -> DataFrame:
    """Give each row its chunk, and a ghost copy in every other chunk it can matter to.

    ``ahead_us``: how much later a row may still be looked at; ``back_us``: how much
    earlier a row may look forward to it.
    """
    t = F.col(us)
    home = floor_div(t, width_us)
    spread = F.sequence(floor_div(t - F.lit(back_us), width_us), floor_div(t + F.lit(ahead_us), width_us))
    return df.withColumn(CHUNK, F.explode(spread)).withColumn(GHOST, F.col(CHUNK) != home)


@dataclass(frozen=True)
class ChunkedSamples:
    """Samples ``keys, _us, value`` that are cut into chunks and lie distributed by (keys, chunk).

    Ghosts reach ``reach_us`` in both directions, so any operator of that reach can work on
    the rows where they are.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    reach_us: int
    width_us: int

    def within(self, keys: Sequence[str], reach_us: int) -> DataFrame:
        if tuple(keys) != self.keys:
            raise ConfigError(f"samples are stored by {list(self.keys)}, not by {list(keys)}")
        if reach_us > self.reach_us:
            raise ConfigError(f"samples are stored for ranges up to {self.reach_us} microseconds, not {reach_us}")
        return self.rows


def carry_last(
    df: DataFrame, keys: Sequence[str], chunk: str, order: str, value: Column, out: str
) -> DataFrame:
    """``out`` = last non-null ``value`` at or before each row of its ordered group.

    The group is cut by ``chunk`` (whose order agrees with ``order``).  Inside a chunk a
    window finds the value; what began in an earlier chunk comes from the chunk summary.
    The summary reads every column, although it needs few, so that both sides of the join
    are planned over the same shuffle and Spark runs it once; the keys should be columns
    without nulls for the same reason.
    """
    inside = Window.partitionBy(*keys, chunk).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    tagged = df.withColumn("_value", value)
    ends = (
        tagged.groupBy(*keys, chunk)
        .agg(
            F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(order))).alias("_end"),
            F.max(F.hash(*tagged.columns)).alias("_read"),
        )
        .where("_read is not null")
        .withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier))
        .drop("_end", "_read")
    )
    return (
        tagged.withColumn(out, F.last("_value", ignorenulls=True).over(inside))
        .join(ends, [*keys, chunk], "left")
        .withColumn(out, F.coalesce(F.col(out), F.col("_carried")))
        .drop("_value", "_carried")
    )
