"""Column contracts of a dataset and the pass-through stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from plumbline.errors import DataError

# The stages that may report, in running order.
STAGES = ("fetch_dataset", "preprocess", "split", "train", "evaluate")
# End of fixed values.


def require_columns(df: DataFrame, columns: Sequence[str], source: str) -> DataFrame:
    """Return ``df`` if it has every column, spelled exactly; runs no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise DataError(f"{source}: missing column(s) {missing}; found {df.columns}")
    return df


def features_target(df: DataFrame, target: str) -> tuple[list[str], str]:
    """Every column but the target is a feature."""
    require_columns(df, [target], "dataset")
    return [c for c in df.columns if c != target], target


def passthrough(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The same rows and header, counted while they pass to whatever sink comes next."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def allow_values(
    df: DataFrame, column: str, allowed: Sequence[str] = STAGES
) -> tuple[DataFrame, DataFrame]:
    """``(accepted, refused)`` rows by membership in a closed list; null is refused."""
    ok = F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return df.where(ok), df.where(~ok)
