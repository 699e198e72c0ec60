"""Documents to a training set, in stages that each write their result for the next.

Each stage takes and returns the columns of ``documents``; the last adds ``n_tokens`` and the
``rate`` at which a document is to be used.  Nulls, empty texts, ties, repeated rows and
empty tables are handled as the operators say; rows that repeat a doc_id stay or go together.
Further columns of any name pass through all stages, but for ``n_tokens`` and ``rate``, which
the last replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.decontaminate import without_contaminated
from plumbline.llm.filters import without_keys
from plumbline.llm.jaccard import shingle_links
from plumbline.llm.linedup import drop_repeated_chunks
from plumbline.llm.mixing import LANGUAGE_WEIGHTS, fit_steps, labelled_domains, learn_domains, with_posteriors, with_rates
from plumbline.llm.text import fresh
from plumbline.llm.toxicity import learn_toxicity, not_held_out, with_toxicity
from plumbline.session import configure, stored

#: A document of this toxicity or more is rejected.
TOXIC = 0.3


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity lies below the limit."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = learn_toxicity(docs, labels, learn=not_held_out())
    (found,) = fresh(docs, "_toxicity")
    return with_toxicity(docs, model, found).where(F.col(f"{found}.score") < TOXIC).drop(found)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay in their first document only.

    A document of which nothing but blanks is left goes; one that was blank before stays.
    """
    cut = drop_repeated_chunks(docs)
    left = (F.col("words_removed") == 0) | F.col("text").rlike(r"\S")
    kept = cut.where(left)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("words_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(dict(docs.dtypes)["n_chars"]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by shingle similarity, the one of smallest doc_id."""
    links = shingle_links(docs)
    gone = stored(links.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return without_keys(docs, F.col("doc_id").cast("long"), gone)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the rates that bring the languages to their target weights.

    Columns ``n_tokens`` and ``rate`` of ``docs`` are replaced.
    """
    docs = docs.drop("n_tokens", "rate")
    (found,) = fresh(docs, "_mix")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = learn_domains(labelled_domains(docs, labels))
    measured = with_posteriors(docs, model, found)
    small = stored(measured.select(f"{found}.n_tokens", f"{found}.posterior"), "mix")
    steps = fit_steps(small, model, LANGUAGE_WEIGHTS) if model.names else []
    rated = with_rates(measured, steps, posterior=f"{found}.posterior")
    return rated.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{found}.n_tokens").alias("n_tokens"), "rate")


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", dedup_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix_languages),
]

# The classifiers and the contraction of components are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
