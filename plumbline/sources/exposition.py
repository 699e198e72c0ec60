"""Metric samples as text, one a line: ``name{label="value",...} value milliseconds``.

Lines are parsed by SQL functions, in batch and in streams alike, so offsets, files and
partitions are those of Spark's text source.  Lines that do not parse are kept apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = "[a-zA-Z_:][a-zA-Z0-9_:]*"
_LABEL = "[a-zA-Z_][a-zA-Z0-9_]*"
_QUOTED = r'(?:[^"\\]|\\.)*+'
_ONE = rf'\s*+{_LABEL}\s*+=\s*+"{_QUOTED}"\s*+'
_PAIR = rf'({_LABEL})\s*+=\s*+"({_QUOTED})"'
_NUMBER = r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[+-]?[Ii]nf|[Nn]a[Nn]"
# Possessive, so that a line that does not fit is refused in one pass.
LINE = rf"^\s*+({_NAME})(?:\s*+\{{((?:{_ONE}(?:,{_ONE})*+,?+)?+)\s*+\}})?+\s++({_NUMBER})(?:\s++(-?[0-9]{{1,15}}))?+\s*+$"


def _unescaped(text: Column) -> Column:
    """``\\\\``, ``\\"`` and ``\\n`` undone; a zero character stands for a backslash in between."""
    held = F.replace(text, F.lit("\\\\"), F.lit("\0"))
    held = F.replace(F.replace(held, F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n"))
    return F.replace(held, F.lit("\0"), F.lit("\\"))


def _escaped(text: Column) -> Column:
    held = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(held, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))


def parse_samples(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(metric, labels, ts, value, bad)``: a sample a line, or the line itself as ``bad``.

    Blank lines and comments (``#``) give nothing.  A sample without a time has a null one.
    A label that occurs twice makes a line bad.  A null line gives nothing.
    """
    line = F.col(f"`{column}`")
    kept = lines.where(line.isNotNull() & ~line.rlike(r"^\s*(#|$)"))
    part = lambda i: F.regexp_extract(line, LINE, i)
    names = F.regexp_extract_all(F.col("_body"), F.lit(_PAIR), F.lit(1))
    texts = F.regexp_extract_all(F.col("_body"), F.lit(_PAIR), F.lit(2))
    fits = line.rlike(LINE) & (F.size(F.array_distinct("_names")) == F.size("_names"))
    number = F.lower("_number")
    infinite = F.when(number.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    value = F.when(number.endswith("inf"), infinite).when(number == "nan", F.lit(float("nan"))).otherwise(F.expr("try_cast(_number as double)"))
    ms = F.expr("try_cast(_ms as bigint)")
    cut = (
        kept.withColumns({"_body": part(2), "_number": part(3), "_ms": part(4), "_metric": part(1)})
        .withColumns({"_names": names, "_texts": F.transform(texts, _unescaped)})
        .withColumn("_fits", fits)
    )
    good = lambda c: F.when(F.col("_fits"), c)
    # A map with a name that occurs twice is an error even where it is not used.
    safe = lambda c: F.when(F.col("_fits"), F.col(c)).otherwise(F.array().cast("array<string>"))
    return cut.select(
        good(F.col("_metric")).alias("metric"),
        good(F.map_from_arrays(safe("_names"), safe("_texts"))).alias("labels"),
        good(F.timestamp_millis(ms)).alias("ts"),
        good(value).alias("value"),
        F.when(~F.col("_fits"), line).alias("bad"),
    )


def sample_lines(samples: DataFrame) -> DataFrame:
    """``value``: each sample as a line.  Times are cut to milliseconds; labels go by name."""
    pairs = F.transform(
        F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit('="'), _escaped(F.coalesce(e["value"], F.lit(""))), F.lit('"'))
    )
    body = F.when(F.size("labels") > 0, F.concat(F.lit("{"), F.concat_ws(",", pairs), F.lit("}"))).otherwise("")
    number = (
        F.when(F.isnan("value"), "NaN").when(F.col("value") == float("inf"), "+Inf").when(F.col("value") == float("-inf"), "-Inf").otherwise(F.col("value").cast("string"))
    )
    time = F.when(F.col("ts").isNotNull(), F.concat(F.lit(" "), F.unix_millis("ts").cast("string"))).otherwise("")
    return samples.where("value is not null").select(F.concat("metric", body, F.lit(" "), number, time).alias("value"))


def write_sample_text(samples: DataFrame, path: str) -> None:
    """Append samples as text files."""
    sample_lines(samples).write.mode("append").text(path)


def read_sample_text(spark: SparkSession, path: str) -> DataFrame:
    """Parsed lines of stored text; ``where("bad is null")`` are the samples."""
    return parse_samples(spark.read.text(path))


def stream_sample_text(spark: SparkSession, path: str, **options) -> DataFrame:
    """The same as a stream over files that come in; options such as ``maxFilesPerTrigger`` pass through."""
    return parse_samples(spark.readStream.options(**options).text(path))
