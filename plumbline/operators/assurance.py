"""Checks over datasets: partitions, keys, digests, rules, lineage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from plumbline.errors import DataError
from plumbline.functions.scalars import row_hash
from plumbline.operators.split import TEST, TRAIN


def overlap(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys found on both sides.  Keys are made distinct first, so no key is hot."""
    names = [key] if isinstance(key, str) else list(key)
    return left.select(*names).distinct().join(right.select(*names).distinct(), names, "left_semi")


def is_disjoint(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> bool:
    return overlap(left, right, key).isEmpty()


def partition_overlap(df: DataFrame, key: str | Sequence[str], part: str = "partition") -> DataFrame:
    """Keys that one labelled frame puts in more than one partition; a single aggregate."""
    names = [key] if isinstance(key, str) else list(key)
    return (
        df.groupBy(*names)
        .agg(F.min(part).alias("_a"), F.max(part).alias("_b"))
        .where("_a <> _b")
        .select(*names)
    )


def coverage(df: DataFrame, part: str = "partition") -> DataFrame:
    """Row counts of one labelled frame: train, test, total, and whether they add up."""
    one = F.lit(1)
    return df.agg(
        F.count(F.when(F.col(part) == TRAIN, one)).alias("n_train"),
        F.count(F.when(F.col(part) == TEST, one)).alias("n_test"),
        F.count(one).alias("n_total"),
    ).withColumn("complete", F.col("n_train") + F.col("n_test") == F.col("n_total"))


def coverage_gaps(
    whole: DataFrame, parts: Sequence[DataFrame], key: str | Sequence[str]
) -> DataFrame:
    """Keys of ``whole`` in no part (``lost``) and keys of a part not in ``whole`` (``added``)."""
    names = [key] if isinstance(key, str) else list(key)
    union = parts[0].select(*names)
    for p in parts[1:]:
        union = union.unionByName(p.select(*names))
    return orphans(whole, union, names, "lost", "added")


def orphans(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    left_only: str = "left_only",
    right_only: str = "right_only",
) -> DataFrame:
    """Keys present on one side only, with the side in ``status``.

    Both directions come from one aggregation over the union of the distinct keys.
    """
    names = [key] if isinstance(key, str) else list(key)
    tag = lambda df, s: df.select(*names).distinct().withColumn("_side", F.lit(s))
    return (
        tag(left, 1)
        .unionByName(tag(right, 2))
        .groupBy(*names)
        .agg(F.sum("_side").alias("_side"))
        .where("_side < 3")
        .select(*names, F.when(F.col("_side") == 1, left_only).otherwise(right_only).alias("status"))
    )


def shared_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Whole rows found on both sides (as a set)."""
    return left.intersect(right.select(*left.columns))


def row_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows one side holds more often than the other: the row, the side, and how many more.

    One aggregation with map-side combining serves both directions.
    """
    cols = left.columns
    sign = lambda df, n: df.select(*cols).withColumn("_sign", F.lit(n))
    return (
        sign(left, 1)
        .unionByName(sign(right, -1))
        .groupBy(*[F.col(f"`{c}`") for c in cols])
        .agg(F.sum("_sign").alias("_more"))
        .where("_more <> 0")
        .withColumn("side", F.when(F.col("_more") > 0, "left").otherwise("right"))
        .withColumn("times", F.abs("_more"))
        .drop("_more")
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether both hold the same bag of rows."""
    return row_difference(left, right).isEmpty()


def leakage(
    df: DataFrame, content: Sequence[str], part: str = "partition"
) -> DataFrame:
    """Row contents that occur in train and in test, with their counts.

    A key check alone misses equal rows under different keys.  Counts are combined per
    content hash on the map side, so one much-repeated row costs one line per task.
    """
    one = F.lit(1)
    return (
        df.groupBy(row_hash(content).alias("content_md5"))
        .agg(
            F.count(F.when(F.col(part) == TRAIN, one)).alias("n_train"),
            F.count(F.when(F.col(part) == TEST, one)).alias("n_test"),
        )
        .where("n_train > 0 and n_test > 0")
    )


def _portable(df: DataFrame, column: str) -> Column:
    """A field's length and text, so that neighbours cannot run into each other."""
    value, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, TimestampNTZType):
        value = F.unix_micros(value.cast("timestamp"))
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def dataset_digest(df: DataFrame, *, portable: bool = False) -> DataFrame:
    """One row that two datasets share exactly when they hold the same bag of rows.

    Row count plus an order-free sum and xor of row hashes (up to hash collisions).
    ``portable`` hashes with md5 over the columns' text, which other engines also have:
    each field as its length, a colon and its text, or ``-`` for a null; times are
    microseconds since the epoch.  Otherwise Spark's faster 64-bit hash is used, over each field
    and whether it is null, since the hash itself passes nulls over.
    """
    if portable:
        h = F.conv(F.substring(F.md5(F.concat(*[_portable(df, c) for c in df.columns])), 1, 15), 16, 10).cast("bigint")
    else:
        fields = [F.col(f"`{c}`") for c in df.columns]
        h = F.xxhash64(*[x for c in fields for x in (c.isNull(), c)])
    return df.select(h.alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).cast("bigint").alias("hash_xor"),
    )


@dataclass(frozen=True)
class Expectation:
    """A named rule every row must satisfy; null counts as a failure."""

    section: str
    name: str
    holds: Column


def run_expectations(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """``(section, name, ok, failed_rows, detail)``, all rules in one aggregate pass."""
    counts = [
        F.count(F.when(~F.coalesce(r.holds, F.lit(False)), 1)).alias(f"_c{i}")
        for i, r in enumerate(rules)
    ]
    line = F.array(
        *[
            F.struct(
                F.lit(r.section).alias("section"),
                F.lit(r.name).alias("name"),
                F.col(f"_c{i}").alias("failed_rows"),
            )
            for i, r in enumerate(rules)
        ]
    )
    failed = F.col("failed_rows")
    return (
        df.agg(*counts)
        .select(F.inline(line))
        .select(
            "section",
            "name",
            (failed == 0).alias("ok"),
            "failed_rows",
            F.when(failed == 0, "").otherwise(F.format_string("%d row(s) fail", failed)).alias("detail"),
        )
    )


def check_summary(checks: DataFrame) -> DataFrame:
    """Passed, failed and total of a table of checks."""
    return checks.agg(
        F.count(F.when(F.col("ok"), 1)).alias("passed"),
        F.count(F.when(~F.col("ok"), 1)).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def require_all_ok(checks: DataFrame) -> None:
    """Raise with the failed checks named; a table of checks has one row per rule."""
    bad = checks.where("not ok").collect()
    if bad:
        raise DataError("; ".join(f"{r['section']}/{r['name']}: {r['detail']}" for r in bad))


def many_writers(lineage: DataFrame) -> DataFrame:
    """Artifacts that more than one stage writes, with the number of writers.

    ``lineage`` is ``(stage, artifact, direction)`` with direction ``dep`` or ``out``.
    """
    return (
        lineage.where("direction = 'out'")
        .select("artifact", "stage")
        .distinct()
        .groupBy("artifact")
        .agg(
            F.count(F.lit(1)).alias("writers"),
            F.min("stage").alias("first_stage"),
            F.max("stage").alias("last_stage"),
        )
        .where("writers > 1")
    )


def shared_inputs(
    lineage: DataFrame, one: Sequence[str], other: Sequence[str]
) -> DataFrame:
    """Artifacts read by a stage of ``one`` and by a stage of ``other``."""
    return (
        lineage.where("direction = 'dep'")
        .groupBy("artifact")
        .agg(
            F.coalesce(F.bool_or(F.col("stage").isin(*one)), F.lit(False)).alias("_a"),
            F.coalesce(F.bool_or(F.col("stage").isin(*other)), F.lit(False)).alias("_b"),
        )
        .where("_a and _b")
        .select("artifact")
    )


def dangling_artifacts(lineage: DataFrame) -> DataFrame:
    """Artifacts read but never written (``unwritten``) or written but never read (``unread``)."""
    return (
        lineage.groupBy("artifact")
        .agg(
            F.bool_or(F.col("direction") == "out").alias("_w"),
            F.bool_or(F.col("direction") == "dep").alias("_r"),
        )
        .where("_w <> _r")
        .select("artifact", F.when(F.col("_w"), "unread").otherwise("unwritten").alias("status"))
    )
