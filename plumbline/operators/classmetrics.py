"""Class balance, accuracy, confusion matrix and per-class report.

Everything is derived from counts of (label, prediction) pairs, which are combined on the
map side; after that the data is one row per pair of classes.  A null label or prediction is
a class of its own that nothing matches: it counts in every denominator and never as a hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Rows and share of each class."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        df.groupBy(F.col(target).alias("class"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("share", F.col("n_rows") / total)
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows predicted right; no rows, no result."""
    hit = F.coalesce((F.col(label) == F.col(prediction)).cast("double"), F.lit(0.0))
    return df.agg(F.avg(hit).alias("accuracy")).where("accuracy is not null")


def pair_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The confusion matrix without its zero cells."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", *, dense: bool = True
) -> DataFrame:
    """Cells over the union of true and predicted classes.

    ``dense`` gives every cell, zeros included: as many rows as the square of the classes,
    each built from one list of the classes, the square root of the result.  Without it
    only cells with rows are given, for any number of classes.
    """
    pairs = pair_counts(df, label, prediction)
    if not dense:
        return pairs
    # Lists leave nulls out, so a class is wrapped.
    axis = (
        pairs.select(F.explode(F.array(F.struct(F.col("label").alias("c")), F.struct(F.col("prediction").alias("c")))).alias("c"))
        .distinct()
        .agg(F.sort_array(F.collect_list("c")).alias("cs"))
    )
    cells = axis.select("cs", F.explode("cs").alias("l")).select("l", F.explode("cs").alias("p"))
    found = pairs.select(F.struct(F.col("label").alias("c")).alias("l"), F.struct(F.col("prediction").alias("c")).alias("p"), "n")
    return cells.join(found, ["l", "p"], "left").select(
        F.col("l.c").alias("label"), F.col("p.c").alias("prediction"), F.coalesce("n", F.lit(0)).alias("n")
    )


def _safe(part: Column, whole: Column) -> Column:
    """Quotient with 0 for a zero divisor."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, f1 and support of each class."""
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    same = F.col("label") == F.col("prediction")
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            n.alias("support"),
            zero.alias("predicted"),
            F.when(same, n).otherwise(zero).alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            zero.alias("support"),
            n.alias("predicted"),
            zero.alias("hits"),
        ),
    )
    return (
        pair_counts(df, label, prediction)
        .select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .withColumn("precision", _safe(F.col("hits"), F.col("predicted")))
        .withColumn("recall", _safe(F.col("hits"), F.col("support")))
        .withColumn(
            "f1",
            _safe(
                2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
            ),
        )
    )


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per class, then ``accuracy``, ``macro avg`` and ``weighted avg``."""
    classes = per_class(df, label, prediction)
    names = ("precision", "recall", "f1")
    total = F.sum("support")
    rows = F.array(
        F.struct(
            F.lit("accuracy").alias("class"),
            *[_safe(F.col("hits"), F.col("total")).alias(c) for c in names],
            F.col("total").alias("support"),
        ),
        F.struct(
            F.lit("macro avg").alias("class"),
            *[F.col(f"m_{c}").alias(c) for c in names],
            F.col("total").alias("support"),
        ),
        F.struct(
            F.lit("weighted avg").alias("class"),
            *[_safe(F.col(f"w_{c}"), F.col("total")).alias(c) for c in names],
            F.col("total").alias("support"),
        ),
    )
    summary = (
        classes.agg(
            total.alias("total"),
            F.sum("hits").alias("hits"),
            *[F.avg(c).alias(f"m_{c}") for c in names],
            *[F.sum(F.col(c) * F.col("support")).alias(f"w_{c}") for c in names],
        )
        .where("total > 0")
        .select(F.inline(rows))
    )
    return classes.select(
        F.col("class").cast("string").alias("class"), *names, "support"
    ).unionByName(summary)


def report_text(report: DataFrame, digits: int = 2) -> DataFrame:
    """One text line per report row, for logs and text artifacts."""
    cell = lambda c: F.lpad(F.format_string(f"%.{digits}f", F.col(c)), 10, " ")
    return report.select(
        "class",
        F.concat(
            F.lpad("class", 14, " "),
            *[cell(c) for c in ("precision", "recall", "f1")],
            F.lpad(F.col("support").cast("string"), 10, " "),
        ).alias("line"),
    )
