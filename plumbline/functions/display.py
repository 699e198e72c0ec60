"""Value mappings and threshold bands used on status panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 0/1 texts of the status panels.
UP_DOWN = {0: "DOWN", 1: "Up"}
OK_FAILED = {0: "FAILED", 1: "OK"}
SUCCEEDED = {0: "NOT succeeded", 1: "Succeeded"}
# End of fixed values.


def map_value(value: Column | str, texts: Mapping[float, str]) -> Column:
    """Text for each listed value; anything else, null included, gives null."""
    v = F.col(value) if isinstance(value, str) else value
    out = F.lit(None).cast("string")
    for key, text in texts.items():
        out = F.when(v == float(key), F.lit(text)).otherwise(out)
    return out


def band(value: Column | str, steps: Sequence[tuple[float | None, str]]) -> Column:
    """Name of the last step whose lower bound is at or below the value.

    ``steps`` is ordered; the first may have the bound ``None`` and is then the base.
    """
    v = F.col(value) if isinstance(value, str) else value
    out = F.lit(None).cast("string")
    for lower, name in steps:
        out = F.when(v.isNotNull(), F.lit(name)) if lower is None else (
            F.when(v >= F.lit(float(lower)), F.lit(name)).otherwise(out)
        )
    return out
