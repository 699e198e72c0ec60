"""Bounded samples of labelled documents, from which the classifiers learn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int) -> DataFrame:
    """At most ``bound`` rows ``doc_id, label, text``: those of smallest hash among ``learn``.

    ``learn`` is a condition on doc_id.  A null label or doc_id is not a label; of several
    labels of a document the largest counts.  The chosen keys (``bound`` at most) are
    broadcast, so the texts are read once and only chosen ones move.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
