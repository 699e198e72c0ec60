"""Seeded labelled data that is the same on any layout."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 52


def hash_uniform(seed: int, *parts: Column | str) -> Column:
    """A number in (0, 1) fixed by the seed and the parts."""
    text = F.concat_ws("|", F.lit(str(seed)), *parts)
    digits = F.conv(F.substring(F.md5(text), 1, _BITS // 4), 16, 10).cast("bigint")
    return (digits + F.lit(0.5)) / F.lit(float(2**_BITS))


def hash_normal(seed: int, *parts: Column | str) -> Column:
    """A standard normal number fixed by the seed and the parts (Box-Muller)."""
    radius = F.sqrt(-2.0 * F.log(hash_uniform(seed, *parts, F.lit("r"))))
    return radius * F.cos(2.0 * math.pi * hash_uniform(seed, *parts, F.lit("a")))


@dataclass(frozen=True)
class Feature:
    """A feature drawn around ``center + shift * class``.

    ``spread`` is the deviation of a normal, or half the width of a uniform draw.
    """

    name: str
    center: float
    spread: float
    shift: float = 0.0
    digits: int = 0
    uniform: bool = False
    lowest: float | None = None

    def column(self, seed: int, key: str, target: str) -> Column:
        at = (F.col(key).cast("string"), F.lit(self.name))
        draw = (
            2.0 * hash_uniform(seed, *at) - 1.0 if self.uniform else hash_normal(seed, *at)
        )
        value = F.lit(self.center) + F.lit(self.shift) * F.col(target) + F.lit(self.spread) * draw
        if self.lowest is not None:
            value = F.greatest(value, F.lit(self.lowest))
        rounded = F.bround(value, self.digits)
        return rounded.cast("bigint") if self.digits == 0 else rounded


def labelled_features(
    keys: DataFrame, key: str, target: str, features: Sequence[Feature], seed: int
) -> DataFrame:
    """Features for every (key, class) row; only the row itself decides its values."""
    return keys.select(
        key, *[f.column(seed, key, target).alias(f.name) for f in features], target
    )


def interleaved(rows: DataFrame, target: str, rank: str = "_rank") -> DataFrame:
    """Order rows by their place inside the class, then by class."""
    return rows.orderBy(rank, target)
