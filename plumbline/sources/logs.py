"""Reading log files of the form ``time | LEVEL | stage | message``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.chunks import carry_last

# Fixed value: the line format (the level is padded with blanks).
LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \| ([A-Z]+) *\| ([^|]*?) \| (.*)$"
# End of fixed value.


def parse_line(line: str = "value"):
    """``struct(ts, level, stage, message)`` of one log line, or null."""
    part = lambda i: F.regexp_extract(line, LINE, i)
    return F.when(
        F.col(line).rlike(LINE),
        F.struct(
            F.to_timestamp_ntz(part(1), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
            part(2).alias("level"),
            part(3).alias("stage"),
            part(4).alias("message"),
        ),
    )


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Every line, with ``continuation`` set on those that do not start an entry.

    One pass, no shuffle.  A continuation line keeps its text in ``message``.
    """
    entry = parse_line()
    return spark.read.text(path).withColumn("_e", entry).select(
        "_e.ts",
        "_e.level",
        "_e.stage",
        F.coalesce(F.col("_e.message"), F.col("value")).alias("message"),
        F.col("_e").isNull().alias("continuation"),
    )


def read_log_entries(spark: SparkSession, path: str) -> DataFrame:
    """Like ``read_logs``, but a continuation line gets time, level and stage of its entry.

    Lines are ordered by file, file block and place in the block.  The place comes from a
    running number that only has to grow inside a block, which holds however blocks are
    spread over tasks; a traceback that crosses a block is carried over.
    """
    lines = (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
        .withColumn("_e", parse_line())
    )
    head = F.when(F.col("_e").isNotNull(), F.struct("_e.ts", "_e.level", "_e.stage"))
    return carry_last(lines, ["file"], "block", "line", head, "_head").select(
        "_head.ts",
        "_head.level",
        "_head.stage",
        F.coalesce(F.col("_e.message"), F.col("value")).alias("message"),
        F.col("_e").isNull().alias("continuation"),
    )


def matching(logs: DataFrame, pattern: str) -> DataFrame:
    """Lines whose message contains the pattern, without regard to case."""
    return logs.where(F.col("message").rlike(f"(?i){pattern}"))
