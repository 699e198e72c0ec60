"""Range and lookback operators on metric samples.

Samples are ``(metric, labels, ts, value)``; ``keys`` are the columns that name one
series (usually ``metric`` and the text of ``series_key``).  Grids are aligned to whole
multiples of the step since the epoch.  All ranges are closed at both ends unless said
otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.errors import ConfigError
from plumbline.functions.labels import series_key
from plumbline.operators.chunks import (
    CHUNK,
    GHOST,
    MICROS,
    ChunkedSamples,
    ceil_div,
    chunk_width,
    floor_div,
    with_chunks,
)

SERIES = ("metric", "series")
_US = "_us"


def with_series(samples: DataFrame) -> DataFrame:
    """Replace the label map by its canonical text ``series``."""
    return samples.select("metric", series_key().alias("series"), "ts", "value")


def _slim(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    return samples.select(*keys, F.unix_micros("ts").alias(_US), "value")


def _chunked(
    samples: DataFrame | ChunkedSamples, keys: Sequence[str], reach: int, chunk_s: int | None, *, ahead: int = 0, back: int = 0
) -> DataFrame:
    """Rows of a series and chunk side by side: as they are stored, or by one exchange.

    The exchange is stated, because windows over finer groups would not serve coarser ones.
    """
    if isinstance(samples, ChunkedSamples):
        return samples.within(keys, reach)
    width = chunk_width(reach, chunk_s and chunk_s * MICROS)
    return with_chunks(_slim(samples, keys), _US, width, ahead_us=ahead, back_us=back).repartition(*keys, CHUNK)


def _time(us: Column) -> Column:
    return F.timestamp_micros(us)


def last_value(samples: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Newest value of each series (partial aggregation, no window)."""
    return samples.groupBy(*keys).agg(
        F.max_by("value", F.struct("ts", "value")).alias("value"), F.max("ts").alias("ts")
    )


def latest_group(df: DataFrame, group: Sequence[str], member: str, ts: str) -> DataFrame:
    """Rows of the newest ``member`` (a run, say) of each group; older ones are absent.

    The winners are one row per group, found with map-side combining.  The join back is a
    semi-join whose small side comes from that aggregate.
    """
    newest = df.groupBy(*group).agg(F.max_by(member, F.struct(ts, member)).alias(member))
    return df.join(newest, [*group, member], "left_semi")


def instant_lookback(
    samples: DataFrame | ChunkedSamples,
    step_s: int,
    lookback_s: int,
    *,
    keys: Sequence[str] = SERIES,
    start: Column | None = None,
    end: Column | None = None,
    closed: bool = True,
    chunk_s: int | None = None,
) -> DataFrame:
    """As-of value on a time grid: the last sample in ``[t - lookback, t]``.

    Each sample is valid from its own time until the next sample of the series or until
    the lookback has passed.  The next sample is found with ``lead`` inside a time chunk,
    and the grid points of that span are then generated, so there is one shuffle, no range
    join, and the output is the only thing that grows with the grid.
    ``closed=False`` leaves out a sample exactly ``lookback`` old.
    """
    step, reach = step_s * MICROS, lookback_s * MICROS
    w = Window.partitionBy(*keys, CHUNK).orderBy(_US, "value")
    lasts = F.least(
        F.col(_US) + F.lit(reach if closed else reach - 1),
        F.coalesce(F.col("_next") - 1, F.lit(2**62)),
        *([] if end is None else [F.unix_micros(end)]),
    )
    firsts = F.col(_US) if start is None else F.greatest(F.col(_US), F.unix_micros(start))
    return (
        _chunked(samples, keys, reach, chunk_s, back=reach)
        .withColumn("_next", F.lead(_US).over(w))
        .where(~F.col(GHOST))
        .withColumn("_k0", ceil_div(firsts, step))
        .withColumn("_k1", floor_div(lasts, step))
        .where("_k0 <= _k1")
        .select(
            *keys,
            F.explode(F.sequence("_k0", "_k1")).alias("_k"),
            "value",
            _time(F.col(_US)).alias("sample_ts"),
        )
        .select(*keys, _time(F.col("_k") * F.lit(step)).alias("t"), "value", "sample_ts")
    )


_BLOCK, _FIRST = "_block", "_first"


def _sliding(
    df: DataFrame, keys: Sequence[str], reach: int, parts: dict[str, tuple], kept: Sequence[str] = ()
) -> DataFrame:
    """Aggregates over ``[t - reach, t]`` at each row of a chunk, at a cost linear in the rows.

    Time is cut into blocks of the range's length.  A range that ends in a block is the end
    of the block before, from the first row of the range on, and the start of its own block:
    two running aggregates, one from either end.  ``parts`` maps a name to
    ``(aggregate, column, combination)``.  The first row of the range is kept in ``_first``
    with the columns ``kept``.  A frame that slides at both ends would be computed anew for
    every row.  Three sorts serve any number of parts: all aggregates of a direction are
    computed together.
    """
    group = [*keys, CHUNK]
    up = Window.partitionBy(*group, _BLOCK).orderBy(_US).rangeBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*group, _BLOCK).orderBy(F.desc(_US)).rangeBetween(Window.unboundedPreceding, 0)
    row = Window.partitionBy(*group).orderBy(_US)
    so_far = row.rangeBetween(Window.unboundedPreceding, 0)
    before = row.rangeBetween(Window.unboundedPreceding, -reach - 1)
    df = df if _BLOCK in df.columns else df.withColumn(_BLOCK, floor_div(F.col(_US), reach))
    df = df.withColumns({f"_up{name}": how(column).over(up) for name, (how, column, _) in parts.items()})
    df = df.withColumns({f"_down{name}": how(column).over(down) for name, (how, column, _) in parts.items()})
    seen = F.struct(_BLOCK, *kept, *[f"_down{n}" for n in parts])
    df = df.withColumn("_seen", seen).withColumn("_next", F.lead("_seen").over(row))
    # The row after the last one that lies before the range, or else the first row of all.
    df = df.withColumn(_FIRST, F.coalesce(F.last("_next").over(before), F.first("_seen").over(so_far)))
    for name, (_, _, both) in parts.items():
        own, earlier = F.col(f"_up{name}"), F.col(f"{_FIRST}._down{name}")
        whole = F.when(F.col(f"{_FIRST}.{_BLOCK}") < F.col(_BLOCK), both(earlier, own)).otherwise(own)
        df = df.withColumn(name, whole)
    return df.drop("_seen", "_next", _BLOCK, *[f"_{x}{n}" for x in ("up", "down") for n in parts])


def _add(a: Column, b: Column) -> Column:
    """The sum of what is there; null if neither is."""
    return F.coalesce(a + b, a, b)


_OVER_TIME = {"max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg, "count": F.count}


def over_time(
    samples: DataFrame | ChunkedSamples,
    range_s: int,
    how: str = "max",
    *,
    keys: Sequence[str] = SERIES,
    chunk_s: int | None = None,
) -> DataFrame:
    """``how`` over ``[ts - range, ts]``, at each sample of the series."""
    if how not in _OVER_TIME:
        raise ConfigError(f"how must be one of {sorted(_OVER_TIME)}, got {how!r}")
    reach = range_s * MICROS
    chunked = _chunked(samples, keys, reach, chunk_s, ahead=reach)
    if how == "avg":
        parts = {"_sum": (F.sum, "value", _add), "_n": (F.count, "value", _add)}
        done = _sliding(chunked, keys, reach, parts).withColumn("over", F.try_divide("_sum", "_n"))
    else:
        both = {"max": F.greatest, "min": F.least}.get(how, _add)
        done = _sliding(chunked, keys, reach, {"over": (_OVER_TIME[how], "value", both)})
    return done.where(~F.col(GHOST)).select(*keys, _time(F.col(_US)).alias("ts"), "value", "over")


def grid_window(range_s: int, step_s: int, ts: str = "ts", tail_us: int = 1) -> Column:
    """The sliding windows ``[t - range, t]`` for every grid time ``t``.

    Spark's windows are half-open; one extra microsecond, the resolution of a timestamp,
    makes them closed.  ``tail_us`` is for times of a coarser resolution.  Works on batch
    and on streaming frames.
    """
    if range_s < step_s:
        raise ConfigError("the range must be at least one step")
    offset = (-range_s) % step_s
    return F.window(
        ts, f"{range_s * MICROS + tail_us} microseconds", f"{step_s} seconds", f"{offset} seconds"
    )


def grid_time(window: str = "_w") -> Column:
    """Evaluation time of a window from ``grid_window``: its last microsecond.

    Also carries the watermark of a streaming frame on to the next operator.
    """
    return F.window_time(window)


def over_time_grid(
    samples: DataFrame,
    range_s: int,
    step_s: int,
    how: str = "max",
    *,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """``how`` over ``[t - range, t]`` at every grid time with a sample in range.

    Samples are first reduced to panes, the longest stretches that both the range and the
    step are made of; only panes are copied to the windows they are part of.  Both steps
    combine rows on the map side.  A streaming frame is a plain sliding aggregate.
    """
    if how not in _OVER_TIME:
        raise ConfigError(f"how must be one of {sorted(_OVER_TIME)}, got {how!r}")
    if not samples.isStreaming:
        parts = ["sum", "count"] if how == "avg" else [how]
        again = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
        out = _paned(
            samples,
            range_s,
            step_s,
            keys,
            [_OVER_TIME[x]("value").alias(x) for x in parts],
            [again[x](x).alias(x) for x in parts],
        )
        value = F.try_divide("sum", "count") if how == "avg" else F.col(how)
        return out.select(*keys, "t", value.alias("value"))
    return (
        samples.groupBy(*keys, grid_window(range_s, step_s).alias("_w"))
        .agg(_OVER_TIME[how]("value").alias("value"))
        .select(*keys, grid_time().alias("t"), "value")
    )


def _paned(
    samples: DataFrame,
    range_s: int,
    step_s: int,
    keys: Sequence[str],
    first: Sequence[Column],
    again: Sequence[Column],
) -> DataFrame:
    """Window aggregates from panes ``((k - 1) p, k p]``: ``first`` of samples, ``again`` of panes.

    Ranges are closed at both ends, so what lies exactly on the end of a pane is also kept
    apart: it belongs to the range that starts there.
    """
    if range_s < step_s:
        raise ConfigError("the range must be at least one step")
    pane, reach, step = math.gcd(range_s, step_s) * MICROS, range_s * MICROS, step_s * MICROS
    us = F.unix_micros("ts")
    end = ceil_div(us, pane) * F.lit(pane)
    panes = (
        samples.where("ts is not null")
        .groupBy(*keys, end.alias("_end"), (us == end).alias("_edge"))
        .agg(*first)
    )
    # A pane lies in the ranges that end from its own end on, and start before it or, if it
    # is an edge, at its end.
    last = F.col("_end") - F.lit(pane) + F.lit(reach) + F.when(F.col("_edge"), F.lit(pane)).otherwise(F.lit(0))
    lowest, highest = ceil_div(F.col("_end"), step), floor_div(last, step)
    return (
        panes.where(lowest <= highest)
        .withColumn("_k", F.explode(F.sequence(lowest, highest)))
        .groupBy(*keys, "_k")
        .agg(*again)
        .withColumn("t", _time(F.col("_k") * F.lit(step)))
        .drop("_k")
    )


def _before(keys: Sequence[str]) -> Column:
    """The value of the sample before; ordered as the running aggregates are, so it costs no sort of its own."""
    return F.lag("value").over(Window.partitionBy(*keys, CHUNK).orderBy(_BLOCK, _US))


def counter_steps(
    samples: DataFrame | ChunkedSamples, range_s: int, *, keys: Sequence[str] = SERIES, chunk_s: int | None = None
) -> DataFrame:
    """Growth since the previous sample of the series; a drop counts as a restart at 0.

    The first sample that has no predecessor within ``range_s`` gets null: no range
    of that length can hold both, so its growth is never summed.
    """
    reach = range_s * MICROS
    before = _before(keys)
    grown = F.when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    chunked = _chunked(samples, keys, reach, chunk_s, ahead=reach)
    return chunked.withColumn(_BLOCK, floor_div(F.col(_US), reach)).withColumn("_grown", grown)


def _growth(range_us: int, extrapolate: bool, end_us: Column) -> Column:
    """Counter growth of one range from its summary columns.

    ``_n`` samples, ``_sum`` of growth, ``_g0`` growth of the first sample (it reaches back
    outside the range), ``_v0`` first value, ``_t0``/``_t1`` first and last time.
    Extrapolation stretches the sampled span to the range ends: by the distance to an end
    if that is below 1.1 average sample gaps, else by half a gap, and never below a
    counter value of zero at the start.
    """
    raw = F.col("_sum") - F.coalesce(F.col("_g0"), F.lit(0.0))
    if not extrapolate:
        return F.when(F.col("_n") >= 2, raw)
    span = (F.col("_t1") - F.col("_t0")).cast("double")
    gap = span / (F.col("_n") - 1)
    to_start = (F.col("_t0") - (end_us - F.lit(range_us))).cast("double")
    to_end = (end_us - F.col("_t1")).cast("double")
    start = F.when(to_start < gap * 1.1, to_start).otherwise(gap / 2)
    to_zero = span * (F.col("_v0") / raw)
    start = F.when((raw > 0) & (F.col("_v0") >= 0), F.least(start, to_zero)).otherwise(start)
    stretch = span + start + F.when(to_end < gap * 1.1, to_end).otherwise(gap / 2)
    return F.when((F.col("_n") >= 2) & (F.col("_t1") > F.col("_t0")), raw * (stretch / span))


def increase(
    samples: DataFrame | ChunkedSamples,
    range_s: int,
    *,
    keys: Sequence[str] = SERIES,
    extrapolate: bool = True,
    chunk_s: int | None = None,
) -> DataFrame:
    """Counter growth over ``[ts - range, ts]`` at each sample; one sample gives no row."""
    reach = range_s * MICROS
    parts = {"_n": (F.count, "value", _add), "_sum": (F.sum, "_grown", _add)}
    steps = counter_steps(samples, range_s, keys=keys, chunk_s=chunk_s)
    return (
        _sliding(steps, keys, reach, parts, ["_grown", "value", _US])
        .withColumns(
            {
                "_g0": F.col(f"{_FIRST}._grown"),
                "_v0": F.col(f"{_FIRST}.value"),
                "_t0": F.col(f"{_FIRST}.{_US}"),
                "_t1": F.col(_US),
            }
        )
        .where(~F.col(GHOST))
        .select(
            *keys,
            _time(F.col(_US)).alias("ts"),
            _growth(reach, extrapolate, F.col(_US)).alias("value"),
        )
        .where(F.col("value").isNotNull())
    )


def rate(samples: DataFrame | ChunkedSamples, range_s: int, **options) -> DataFrame:
    """Growth per second over the range."""
    return increase(samples, range_s, **options).withColumn(
        "value", F.col("value") / F.lit(float(range_s))
    )


def increase_grid(
    samples: DataFrame | ChunkedSamples,
    range_s: int,
    step_s: int,
    *,
    keys: Sequence[str] = SERIES,
    extrapolate: bool = True,
    chunk_s: int | None = None,
) -> DataFrame:
    """Counter growth over ``[t - range, t]`` at every grid time.

    Growth between neighbours needs one chunked window; the ranges are then aggregates of
    its panes.
    """
    reach = range_s * MICROS
    steps = (
        counter_steps(samples, range_s, keys=keys, chunk_s=chunk_s)
        .where(~F.col(GHOST))
        .select(*keys, _time(F.col(_US)).alias("ts"), _US, "value", "_grown")
    )
    summary = F.min_by(F.struct("value", "_grown"), _US)
    first = [
        F.count("value").alias("_n"),
        F.sum("_grown").alias("_sum"),
        summary.alias("_first"),
        F.min(_US).alias("_t0"),
        F.max(_US).alias("_t1"),
    ]
    again = [
        F.sum("_n").alias("_n"),
        F.sum("_sum").alias("_sum"),
        F.min_by("_first", "_t0").alias("_first"),
        F.min("_t0").alias("_t0"),
        F.max("_t1").alias("_t1"),
    ]
    return (
        _paned(steps, range_s, step_s, keys, first, again)
        .select(
            *keys,
            "t",
            "_n",
            "_sum",
            "_t0",
            "_t1",
            F.col("_first.value").alias("_v0"),
            F.col("_first._grown").alias("_g0"),
        )
        .select(
            *keys, "t", _growth(reach, extrapolate, F.unix_micros("t")).alias("value")
        )
        .where(F.col("value").isNotNull())
    )


def rate_grid(samples: DataFrame, range_s: int, step_s: int, **options) -> DataFrame:
    """Growth per second on the grid."""
    return increase_grid(samples, range_s, step_s, **options).withColumn(
        "value", F.col("value") / F.lit(float(range_s))
    )


def changes(
    samples: DataFrame | ChunkedSamples, range_s: int, *, keys: Sequence[str] = SERIES, chunk_s: int | None = None
) -> DataFrame:
    """How often the value changed within ``[ts - range, ts]``, at each sample."""
    reach = range_s * MICROS
    before = _before(keys)
    moved = F.when(before.isNull() | (F.col("value") == before), 0).otherwise(1)
    chunked = _chunked(samples, keys, reach, chunk_s, ahead=reach).withColumn(_BLOCK, floor_div(F.col(_US), reach))
    return (
        _sliding(chunked.withColumn("_moved", moved.cast("bigint")), keys, reach, {"_all": (F.sum, "_moved", _add)}, ["_moved"])
        # The first sample of the range compares with one outside it.
        .withColumn("changes", F.col("_all") - F.col(f"{_FIRST}._moved"))
        .where(~F.col(GHOST))
        .select(*keys, _time(F.col(_US)).alias("ts"), "changes")
    )


def retained(samples: DataFrame, days: int, now: Column) -> DataFrame:
    """Samples not older than ``days``; the bound is a plain comparison, so it is pushed."""
    return samples.where(F.col("ts") >= now - F.make_dt_interval(days=F.lit(days)))
