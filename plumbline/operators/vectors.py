"""Aggregates and arithmetic on instant vectors.

An empty selection gives no row, never a null or a zero: a metric that is absent is not
the same as one that is down.  ``at`` lists extra columns kept apart in every operation,
such as the evaluation time ``t``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.errors import ConfigError
from plumbline.functions.labels import Selector, label

_HOW = {"max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg, "count": F.count}


def _agg(how: str, value: Column) -> Column:
    if how not in _HOW:
        raise ConfigError(f"aggregate must be one of {sorted(_HOW)}, got {how!r}")
    return _HOW[how](value)


def _groups(df: DataFrame, by: Sequence[str], at: Sequence[str]) -> list[Column]:
    return [*[F.col(c) for c in at], *[label(n, df.columns).alias(n) for n in by]]


def aggregate(
    vector: DataFrame, how: str, by: Sequence[str] = (), at: Sequence[str] = ()
) -> DataFrame:
    """``max|min|sum|avg|count`` over the series, optionally by labels."""
    rows = vector.where(F.col("value").isNotNull())
    out = rows.groupBy(*_groups(vector, by, at)).agg(
        _agg(how, F.col("value")).alias("value"), F.count("value").alias("_n")
    )
    return out.where("_n > 0").drop("_n")


def combine(
    vector: DataFrame,
    left: tuple[str, Selector],
    right: tuple[str, Selector],
    op: str,
    *,
    scale: float = 1.0,
    by: Sequence[str] = (),
    at: Sequence[str] = (),
) -> DataFrame:
    """``scale * left / right`` or ``scale * (left - right)`` of two aggregates, in one pass.

    Both sides are conditional aggregates of the same scan.  A group with either side
    missing has no result, and neither has a division by zero.
    """
    cols = vector.columns
    (lh, ls), (rh, rs) = left, right
    lc, rc = ls.condition(cols), rs.condition(cols)
    out = (
        vector.where(lc | rc)
        .groupBy(*_groups(vector, by, at))
        .agg(
            _agg(lh, F.when(lc, F.col("value"))).alias("_l"),
            _agg(rh, F.when(rc, F.col("value"))).alias("_r"),
            F.count(F.when(lc, F.col("value"))).alias("_ln"),
            F.count(F.when(rc, F.col("value"))).alias("_rn"),
        )
        .where("_ln > 0 and _rn > 0")
    )
    if op == "ratio":
        value = F.try_divide(F.lit(float(scale)) * F.col("_l"), F.col("_r"))
    elif op == "difference":
        value = F.lit(float(scale)) * (F.col("_l") - F.col("_r"))
    else:
        raise ConfigError(f"op must be 'ratio' or 'difference', got {op!r}")
    return out.withColumn("value", value).where("value is not null").drop("_l", "_r", "_ln", "_rn")


def ratio_of_sums(vector: DataFrame, part: Selector, whole: Selector, **options) -> DataFrame:
    """``100 * sum(part) / sum(whole)``."""
    return combine(vector, ("sum", part), ("sum", whole), "ratio", **{"scale": 100.0, **options})


def match_series(
    vector: DataFrame, left: str, right: str, *, at: Sequence[str] = (), series: str = "series"
) -> DataFrame:
    """One-to-one match of two metrics on all labels but the name.

    Both metrics come from the same scan and meet in one aggregation, which needs no join
    and combines on the map side; a series that lacks either side vanishes.  Two samples
    of one side under the same labels are a mistake in the input and raise.
    """
    is_l, is_r = F.col("metric") == left, F.col("metric") == right
    return (
        vector.where(is_l | is_r)
        .groupBy(*at, series)
        .agg(
            F.max(F.when(is_l, F.col("value"))).alias("left_value"),
            F.max(F.when(is_r, F.col("value"))).alias("right_value"),
            F.count(F.when(is_l, F.col("value"))).alias("_ln"),
            F.count(F.when(is_r, F.col("value"))).alias("_rn"),
        )
        .where("_ln > 0 and _rn > 0")
        .withColumn(
            "left_value",
            F.when(
                (F.col("_ln") > 1) | (F.col("_rn") > 1),
                F.raise_error(F.lit("more than one sample per side and label set")).cast("double"),
            ).otherwise(F.col("left_value")),
        )
        .drop("_ln", "_rn")
    )


def float_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as floats divide: by zero gives an infinity, and zero by zero NaN, not an error."""
    return F.when(whole == 0, part * F.lit(float("inf"))).otherwise(F.try_divide(part, whole))


def wide_status(
    vector: DataFrame, metrics: Mapping[str, str], shared: Sequence[str], at: Sequence[str] = ()
) -> DataFrame:
    """Several metrics side by side, one row per shared label set, in one aggregation.

    ``metrics`` maps metric name to column name; a metric without a sample is null.
    """
    return (
        vector.where(F.col("metric").isin(*metrics))
        .groupBy(*_groups(vector, shared, at))
        .agg(
            *[
                F.max(F.when(F.col("metric") == m, F.col("value"))).alias(name)
                for m, name in metrics.items()
            ]
        )
    )


def top_k(df: DataFrame, value: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` largest rows; equal values go in the order of ``ties``."""
    return df.orderBy(F.col(value).desc(), *[F.col(c).asc() for c in ties]).limit(k)


def share_of_total(df: DataFrame, value: str, out: str = "share") -> DataFrame:
    """Each row's part of the total of all rows.

    The total is a scalar subquery, so no window gathers the rows in one task.
    """
    total = df.agg(F.sum(value).alias("total")).scalar()
    return df.withColumn(out, F.try_divide(F.col(value), total))


def dominant(df: DataFrame, value: str) -> DataFrame:
    """The rows whose value is the largest of all (ties included)."""
    return df.where(F.col(value) == df.agg(F.max(value).alias("top")).scalar())


def organise(
    df: DataFrame, exclude: Sequence[str] = (), rename: Mapping[str, str] | None = None
) -> DataFrame:
    """Drop and rename columns by name; names that are not there are ignored."""
    return df.drop(*exclude).withColumnsRenamed(dict(rename or {}))
