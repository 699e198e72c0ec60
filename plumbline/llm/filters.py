"""Fixed-size filters of 64-bit keys: a cheap first look before an exact join.

A filter never loses a key it was built from and may pass others, so an exact join follows.
Its size is a parameter and does not grow with the input.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.text import fresh

#: Bits of a filter (1 MB).
FILTER_BITS = 23


def spot(key: Column) -> Column:
    """The bit of a 64-bit hash."""
    return F.shiftrightunsigned(key, 64 - FILTER_BITS)


def spots(hashes: np.ndarray) -> np.ndarray:
    """The same for unsigned hashes in numpy."""
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _bitmaps(keys: DataFrame, key: Column) -> DataFrame:
    """256 bitmaps of 4 kB at most: bucket b holds the spots 32768 (b - 1) to 32768 b - 1."""
    at = spot(key) + 1
    return keys.groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")
    )


def key_filter(keys: DataFrame, key: Column) -> np.ndarray:
    """One byte of 0 or 1 for each spot."""
    marks = np.zeros(1 << FILTER_BITS, np.uint8)
    for row in _bitmaps(keys, key).collect():
        bits = np.unpackbits(np.frombuffer(bytes(row["_bits"]), np.uint8), bitorder="little")
        start = (row["_bucket"] - 1) * 32768
        marks[start : start + 32768] |= bits[: len(marks) - start]
    return marks


def marked(df: DataFrame, key: Column, keys: DataFrame, own: Column, column: str = "_marked") -> DataFrame:
    """``df`` with a flag that is true where ``key`` may be among ``keys`` (``own`` is their hash)."""
    at = spot(key) + 1
    place, bucket, bits = fresh(df, "_at", "_bucket", "_bits")
    with_spot = df.select("*", F.bitmap_bit_position(at).alias(place), F.bitmap_bucket_number(at).alias(bucket))
    octet = f"cast(conv(hex(substring({bits}, cast({place} div 8 as int) + 1, 1)), 16, 10) as int)"
    flag = F.expr(f"coalesce(shiftright({octet}, cast({place} % 8 as int)) & 1 = 1, false)")
    maps = F.broadcast(_bitmaps(keys, own).toDF(bucket, bits))
    return with_spot.join(maps, bucket, "left").withColumn(column, flag).drop(place, bucket, bits)


def without_keys(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``df`` without the rows whose ``key``, a long, is in the one column of ``keys``.

    Rows that the filter clears are passed on as they lie; only the others are shuffled.
    All columns of ``df`` keep their names, order and values, whatever they are called.
    """
    own = F.col(keys.columns[0])
    mine, gone, flag = fresh(df, "_key_of", "_gone", "_marked")
    first = marked(df.select("*", key.alias(mine)), F.xxhash64(mine), keys, F.xxhash64(own), flag)
    columns = [F.col(f"`{c}`") for c in df.columns]
    clear = first.where(~F.col(flag)).select(*columns)
    doubtful = first.where(flag).join(keys.select(own.alias(gone)), F.col(mine) == F.col(gone), "left_anti")
    return clear.union(doubtful.select(*columns))
