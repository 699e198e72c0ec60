"""The driver's tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import configure


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def event_samples(events: DataFrame) -> DataFrame:
    """Events as metric samples: the type is the metric, the user its only label."""
    return events.select(
        F.col("event_type").alias("metric"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("labels"),
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
    )


def document_features(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Simple numeric features of the labelled documents, keyed by ``doc_id``."""
    text = F.col("text")
    count = lambda mark: (F.length(text) - F.length(F.replace(text, F.lit(mark)))).cast("double")
    # Features first: a join then shuffles a few numbers per document, not its text.
    numbers = documents.select(
        "doc_id",
        F.length(text).cast("double").alias("chars"),
        count(" ").alias("blanks"),
        count("\n").alias("lines"),
        count(".").alias("stops"),
        count(",").alias("commas"),
        F.regexp_count(text, F.lit("[0-9]")).cast("double").alias("digits"),
        (F.col("lang") == "en").cast("double").alias("is_en"),
    ).withColumn("word_length", F.col("chars") / (F.col("blanks") + F.col("lines") + 1))
    return numbers.join(labels.select("doc_id", "quality"), "doc_id")
