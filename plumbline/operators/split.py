"""Seeded, exact, stratified partitions that do not depend on the data's layout.

Rows are ordered inside a class by ``md5(seed | key)``.  The held-out part is the first
``n`` rows of that order, where ``n`` is exact.  No class is ever sorted as a whole: its
rows are counted per hash prefix, the prefix where the cut falls is found from the
counts, and only the rows under that one prefix are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.errors import ConfigError, DataError
from plumbline.operators.columns import require_columns

TRAIN, TEST = "train", "test"
# The table of classes is one row per class and is broadcast; this bounds it.
MAX_CLASSES = 100_000
_HASH, _PREFIX, _CLASS = "_hash", "_prefix", "_class"


def hash_order(seed: int, key: Sequence[str]) -> Column:
    """The layout-free order of rows: md5 over the seed and the key columns.

    The parts of a key of several columns come with their lengths, so that different keys
    never give the same text.
    """
    texts = [F.col(c).cast("string") for c in key]
    if len(texts) > 1:
        texts = [F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def require_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise unless the key is unique and never null.

    Counts are combined on the map side, and the job ends at the first duplicate group.
    """
    names = _keys(key)
    require_columns(df, names, "key check")
    missing = F.lit(False)
    for n in names:
        missing = missing | F.col(n).isNull()
    bad = (
        df.select(*names)
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > 1) | missing)
        .limit(1)
        .collect()
    )
    if bad:
        shown = {n: bad[0][n] for n in names}
        raise DataError(f"key {names} is not unique or has nulls, e.g. {shown}")


def class_counts(df: DataFrame, target: str | None, test_size: float) -> list[tuple]:
    """``(class, rows)`` in class order, or the error of a split that cannot be made.

    One aggregate job; what reaches the driver is one row per class, and more classes than
    ``MAX_CLASSES`` are refused.  Without a target everything is one class.
    """
    if not 0.0 < test_size < 1.0:
        raise DataError(f"cannot stratify: test_size must be inside (0, 1), got {test_size}")
    cls = F.col(target) if target else F.lit(0)
    rows = (
        df.groupBy(cls.alias(_CLASS))
        .agg(F.count(F.lit(1)).alias("n"))
        .limit(MAX_CLASSES + 1)
        .collect()
    )
    counts = [(r[_CLASS], r["n"]) for r in rows]
    if any(c is None for c, _ in counts):
        raise DataError(f"cannot stratify: target {target!r} has nulls")
    if len(counts) > MAX_CLASSES:
        raise DataError(f"cannot stratify: more than {MAX_CLASSES} classes in {target!r}")
    total = sum(n for _, n in counts)
    n_test = math.ceil(test_size * total)
    if total < 2 or n_test < 1 or n_test >= total:
        raise DataError(f"cannot stratify: {total} rows leave one side empty")
    if target:
        small = [c for c, n in counts if n < 2]
        if small:
            raise DataError(f"cannot stratify: class(es) {small} have fewer than 2 rows")
        if n_test < len(counts) or total - n_test < len(counts):
            raise DataError("cannot stratify: fewer rows on one side than classes")
    return sorted(counts)


def quotas(counts: Sequence[tuple], test_size: float) -> list[tuple]:
    """``(class, held-out rows)``: floor of each share, then largest remainders.

    Equal remainders go to the smaller class.  Whole numbers, so no share is misrounded.
    """
    total = sum(n for _, n in counts)
    n_test = math.ceil(test_size * total)
    shares = [(c, *divmod(n_test * n, total)) for c, n in counts]
    spare = n_test - sum(base for _, base, _ in shares)
    favoured = {c for c, _, _ in sorted(shares, key=lambda s: (-s[2], s[0]))[:spare]}
    return [(c, base + (c in favoured)) for c, base, _ in shares]


def _cutoffs(tagged: DataFrame, quota: DataFrame) -> DataFrame:
    """The last held-out hash of each class, one row per class."""
    counts = tagged.groupBy(_CLASS, _PREFIX).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(_CLASS).orderBy(_PREFIX)
    edge = (
        counts.join(F.broadcast(quota), _CLASS)
        .withColumn("_upto", F.sum("_n").over(running))
        .where("_upto >= _quota and _upto - _n < _quota")
        .select(_CLASS, _PREFIX, (F.col("_quota") - (F.col("_upto") - F.col("_n"))).alias("_take"))
    )
    in_edge = Window.partitionBy(_CLASS).orderBy(_HASH)
    return (
        tagged.select(_CLASS, _PREFIX, _HASH)
        .join(F.broadcast(edge), [_CLASS, _PREFIX])
        .withColumn("_rank", F.row_number().over(in_edge))
        .where("_rank = _take")
        .select(_CLASS, F.col(_HASH).alias("_cut"))
    )


def stratified_split(
    df: DataFrame,
    target: str | None,
    test_size: float,
    seed: int,
    key: str | Sequence[str],
    *,
    validate: bool = True,
    prefix_digits: int | None = None,
    out: str = "partition",
) -> DataFrame:
    """``df`` plus a column that says ``train`` or ``test``.

    Exactly ``ceil(test_size * rows)`` rows are held out and classes keep their shares.
    Three passes over (key, target), the last of them a plain projection of all columns:
    neither the rows nor any class is shuffled or sorted.  ``prefix_digits`` hex digits
    divide each class into ``16**prefix_digits`` parts.  By default there are about as many
    parts as rows in a part of the largest class: a million of each for 10**12 rows.
    ``validate=False`` leaves out only the key check, for a key already known to be unique.
    """
    names = _keys(key)
    require_columns(df, [*names, *([target] if target else [])], "split")
    if out in df.columns:
        raise ConfigError(f"column {out!r} already exists")
    # Also proves the size of the class tables that are broadcast below.
    counts = class_counts(df, target, test_size)
    if validate:
        require_unique(df, names)
    cls = F.col(target) if target else F.lit(0)
    if prefix_digits is None:
        prefix_digits = max(1, math.ceil(math.log(max(n for _, n in counts), 16) / 2))
    tagged = df.withColumns({_CLASS: cls, _HASH: hash_order(seed, names)})
    slim = tagged.select(_CLASS, _HASH, F.substring(_HASH, 1, prefix_digits).alias(_PREFIX))
    kind = slim.schema[_CLASS].dataType.simpleString()
    quota = df.sparkSession.createDataFrame(
        quotas(counts, test_size), f"{_CLASS} {kind}, _quota bigint"
    )
    cuts = _cutoffs(slim, quota)
    held = F.coalesce(F.col(_HASH) <= F.col("_cut"), F.lit(False))
    return (
        tagged.join(F.broadcast(cuts), _CLASS, "left")
        .withColumn(out, F.when(held, F.lit(TEST)).otherwise(F.lit(TRAIN)))
        .select(*df.columns, out)
    )


def random_split(
    df: DataFrame, test_size: float, seed: int, key: str | Sequence[str], **options
) -> DataFrame:
    """The same exact split without classes."""
    return stratified_split(df, None, test_size, seed, key, **options)


def rank_in_class(
    df: DataFrame, target: str, seed: int, key: Sequence[str], prefix_digits: int = 4
) -> DataFrame:
    """``_rank``: exact position of each row in its class's hash order, from 1.

    Rows are ranked inside (class, prefix); the rows before that prefix come from the
    prefix counts.  A class of any size spreads over ``16**prefix_digits`` groups.
    """
    tagged = df.withColumn(_HASH, hash_order(seed, key)).withColumn(
        _PREFIX, F.substring(_HASH, 1, prefix_digits)
    )
    running = Window.partitionBy(target).orderBy(_PREFIX)
    before = (
        tagged.groupBy(target, _PREFIX)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(running) - F.col("_n"))
        .drop("_n")
    )
    inside = Window.partitionBy(target, _PREFIX).orderBy(_HASH)
    return (
        tagged.withColumn("_in", F.row_number().over(inside))
        .join(before, [target, _PREFIX])
        .withColumn("_rank", F.col("_before") + F.col("_in"))
        .select(*df.columns, "_rank")
    )


def stratified_kfold(
    df: DataFrame,
    target: str,
    k: int,
    seed: int,
    key: str | Sequence[str],
    *,
    prefix_digits: int = 4,
    out: str = "fold",
) -> DataFrame:
    """``df`` plus a fold number ``0..k-1``; fold sizes per class differ by at most one.

    A null target is an error, as it is in a split: no row is left out.
    """
    names = _keys(key)
    require_columns(df, [*names, target], "k-fold")
    if k < 2:
        raise ConfigError(f"k must be at least 2, got {k}")
    if not df.where(F.col(target).isNull()).select(target).isEmpty():
        raise DataError(f"cannot stratify: target {target!r} has nulls")
    return (
        rank_in_class(df, target, seed, names, prefix_digits)
        .withColumn(out, ((F.col("_rank") - 1) % k).cast("int"))
        .drop("_rank")
    )
