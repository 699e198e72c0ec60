"""Exact per-series computations over a stream: counter growth, lives of series, late samples.

Samples wait in the state until the watermark has passed them and are then handled in the order
of their times, so results depend neither on the order of arrival nor on how the stream is cut
into micro-batches.  What no later result needs leaves the state.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from plumbline.errors import ConfigError
from plumbline.operators.chunks import MICROS
from plumbline.operators.ranges import SERIES
from plumbline.streaming.alerts import use_rocksdb
from plumbline.streaming.buckets import NEVER, BucketProcessor, numbered, process_buckets

# Executors need not have this package installed: its task code travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Grid times of one table that a task gives.
_GIVEN = 1 << 18
_NONE = np.iinfo(np.int64).min


def _times(us) -> pd.Series:
    return pd.Series(np.asarray(us, "int64")).astype("datetime64[us]")


def _samples(rows: pa.Table, keys: Sequence[str], mark: str, first: int) -> tuple[pa.Table, np.ndarray, list[np.ndarray]]:
    """The rows by series, those marked ``first`` before others, then by time and value; ``(rows, codes, columns)``."""
    code, _ = numbered(rows, keys)
    us, value, marks = (rows.column(c).to_numpy() for c in ("us", "value", mark))
    order = np.lexsort((value, us, marks != first, code))
    return rows.take(pa.array(order)), code[order], [x[order] for x in (us, value, marks)]


class CounterGrowth(BucketProcessor):
    """Growth of a counter over ``[t - range, t]`` at every grid time, resets counted from zero."""

    def __init__(self, n_keys: int, range_s: int, step_s: int, extrapolate: bool):
        # The number of the next grid time of a series is kept with its samples.
        super().__init__(n_keys, {"value": "float64"}, {"next": _NONE})
        self.extrapolate = extrapolate
        self.reach, self.step = range_s * MICROS, step_s * MICROS

    def new_rows(self, batch):
        # Samples without a value are passed over; they move the watermark all the same.
        return batch[batch["value"].notna()]

    def advance(self, rows, now):
        rows, code, (us, value, marks) = _samples(rows, self.keys, "next", NEVER)
        settled = us <= now
        places = np.flatnonzero(settled)
        code, us, value, marks = (x[settled] for x in (code, us, value, marks))
        starts = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(code))[: len(starts)]
        known = np.maximum.reduceat(marks, starts) if len(starts) else starts
        k = np.where(known == _NONE, -(-us[starts] // self.step), known)
        last = np.minimum(now, us[ends - 1] + self.reach) // self.step
        given = self._given(rows, places, us, value, starts, ends, k, last)
        k = np.maximum(k, now // self.step + 1)
        size = ends - starts
        # A series none of whose samples can reach a later grid time starts anew with its next one.
        keep = us >= np.repeat(k * self.step - self.reach, size)
        follows = np.full(rows.num_rows, _NONE)
        follows[places] = np.repeat(k, size)
        kept = np.flatnonzero(~settled)
        kept = np.sort(np.append(kept, places[keep]))
        left = rows.set_column(rows.column_names.index("next"), "next", pa.array(follows)).take(pa.array(kept))
        alive = np.logical_or.reduceat(keep, starts) if len(starts) else np.zeros(0, bool)
        due = [*(k[alive] * self.step).tolist(), *rows.column("us").to_numpy()[~settled].tolist()]
        return given, left, min(due, default=NEVER)

    def _given(self, rows, places, us, value, starts, ends, k, last):
        """The rows of all series with grid times from ``k`` to ``last``, some series at a time."""
        n = np.maximum(last - k + 1, 0)
        block = np.cumsum(n) // _GIVEN
        for b in np.unique(block[n > 0]).tolist():
            of = np.flatnonzero((block == b) & (n > 0))
            out = self._rows(us, value, starts[of], ends[of], k[of], n[of])
            if len(out[0]):
                yield pd.DataFrame({**self.key_columns(rows, places[out[0]]), "t": _times(out[1]), "value": out[2]})

    def _rows(self, us, value, starts, ends, k, n):
        """``(place of the series' first sample, grid time, growth)`` of series with ``n`` grid times from ``k``."""
        size = ends - starts
        of, at = np.repeat(starts, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        grid = (np.repeat(k, n) + at) * self.step
        total = np.zeros(len(us))
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if b - a > 1:
                v = value[a:b]
                total[a + 1 : b] = np.cumsum(np.where(v[1:] < v[:-1], v[1:], v[1:] - v[:-1]))
        low, high = self._found(us, starts, size, n, grid)
        first, final = np.minimum(low, np.repeat(ends, n) - 1), np.maximum(high, of)
        several = (high > low) & (us[final] > us[first] if self.extrapolate else True)
        of, grid, low, high = of[several], grid[several], low[several], high[several]
        raw = total[high] - total[low]
        if self.extrapolate:
            raw = self._stretched(raw, us[low], us[high], value[low], high - low, grid)
        return of, grid, raw

    def _found(self, us, starts, size, n, grid):
        """The first sample inside each grid time's range, and the last one."""
        low, high = np.empty(len(grid), np.int64), np.empty(len(grid), np.int64)
        at = 0
        for a, m, g in zip(starts.tolist(), size.tolist(), n.tolist(), strict=True):
            own, times = us[a : a + m], grid[at : at + g]
            low[at : at + g] = a + np.searchsorted(own, times - self.reach, "left")
            high[at : at + g] = a + np.searchsorted(own, times, "right") - 1
            at += g
        return low, high

    def _stretched(self, raw, first, last, start_value, gaps, end):
        """Stretch to the ends of the range as the batch operator does."""
        span = (last - first).astype(float)
        gap = span / gaps
        to_start, to_end = (first - (end - self.reach)).astype(float), (end - last).astype(float)
        start = np.where(to_start < gap * 1.1, to_start, gap / 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            to_zero = span * (start_value / raw)
        start = np.where((raw > 0) & (start_value >= 0), np.minimum(start, to_zero), start)
        stretch = span + start + np.where(to_end < gap * 1.1, to_end, gap / 2)
        return raw * (stretch / span)


def _stateful(samples: DataFrame, keys: Sequence[str], processor: BucketProcessor, columns: str, delay: str) -> DataFrame:
    return process_buckets(samples.withColumn("value", F.col("value").cast("double")), keys, processor, columns, delay)


def stream_increase_grid(
    samples: DataFrame,
    range_s: int,
    step_s: int,
    *,
    keys: Sequence[str] = SERIES,
    extrapolate: bool = True,
    delay: str = "1 minute",
) -> DataFrame:
    """``increase_grid`` over a stream: a grid time is given once the watermark has passed it.

    State is the samples of one range per series.  Samples later than ``delay`` are dropped
    (``mark_late`` keeps them), as are such without a time or with a null or NaN for a value.
    """
    if range_s < step_s or step_s < 1:
        raise ConfigError("the range must be at least one step")
    return _stateful(samples.where("ts is not null"), keys, CounterGrowth(len(keys), range_s, step_s, extrapolate), "t timestamp, value double", delay)


def stream_rate_grid(samples: DataFrame, range_s: int, step_s: int, **options) -> DataFrame:
    """Growth per second on the grid."""
    return stream_increase_grid(samples, range_s, step_s, **options).withColumn("value", F.col("value") / F.lit(float(range_s)))


class SeriesLife(BucketProcessor):
    """The last value of a series, forgotten when nothing has come for a while."""

    def __init__(self, n_keys: int, lifetime_s: int):
        # The last settled sample of a series is marked; it comes before all others.
        super().__init__(n_keys, {"value": "float64"}, {"last": 0})
        self.lifetime = lifetime_s * MICROS

    def advance(self, rows, now):
        rows, code, (us, value, marks) = _samples(rows, self.keys, "last", 1)
        settled = np.flatnonzero(us <= now)
        later = np.flatnonzero(us > now)
        code, at, value, old = code[settled], us[settled], value[settled], marks[settled] == 1
        other = code[1:] != code[:-1]
        begins = np.append(True, other | (at[1:] - at[:-1] > self.lifetime))[: len(code)]
        closes = np.append(begins[1:], True)[: len(code)]
        final = np.append(other, True)[: len(code)]
        start, end = np.flatnonzero(begins), np.flatnonzero(closes)
        seen = end[(end > start) & ((at[end] != at[start]) | (value[end] != value[start]))]
        known = final & (at + self.lifetime > now)
        appeared, forgotten = np.flatnonzero(begins & ~old), np.flatnonzero(closes & ~known)
        events = [("appeared", appeared, 0), ("seen", seen, 0), ("forgotten", forgotten, self.lifetime)]
        given = [
            pd.DataFrame({**self.key_columns(rows, settled[i]), "event": [name] * len(i), "ts": _times(at[i] + more), "value": value[i]})
            for name, i, more in events
            if len(i)
        ]
        stays = settled[known]
        kept = np.append(stays, later)
        left = rows.take(pa.array(kept))
        left = left.set_column(left.column_names.index("last"), "last", pa.array(np.repeat([1, 0], [len(stays), len(later)])))
        due = np.append(us[stays] + self.lifetime, us[later])
        return given, left, int(due.min()) if len(due) else NEVER


def stream_series_lives(
    samples: DataFrame, lifetime_s: int, *, keys: Sequence[str] = SERIES, delay: str = "1 minute"
) -> DataFrame:
    """Last values with a time to live: ``(keys, event, ts, value)``.

    ``appeared`` is a series' first sample after it was unknown; ``seen`` its newest one when
    the watermark passes it; ``forgotten`` comes ``lifetime_s`` after its last sample, with
    that sample's value, and takes the series out of the state.  A gap longer than the
    lifetime ends a life wherever micro-batches end; a null value counts as a sample.
    """
    if lifetime_s < 1:
        raise ConfigError("the lifetime must be a second at least")
    return _stateful(samples.where("ts is not null"), keys, SeriesLife(len(keys), lifetime_s), "event string, ts timestamp, value double", delay)


_ARRIVED = "arrived_at__"


class LateMark(StatefulProcessor):
    """Tells samples that come too long after the newest one of their series before this batch."""

    def __init__(self, columns: Sequence[str], allowed_s: float, lifetime_s: int):
        self.columns, self.allowed, self.lifetime = list(columns), int(allowed_s * MICROS), lifetime_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.high = handle.getValueState("high", "us bigint, timer bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before, timer = tuple(self.high.get()) if self.high.exists() else (None, None)
        newest, arrived = before, 0
        for batch in rows:
            # Spark gives names with a leading underscore by place only.
            batch.columns = [*self.columns, _ARRIVED]
            whole = batch["ts"].notna().to_numpy()
            us = batch["ts"].astype("datetime64[us]").astype("int64").to_numpy()
            behind = np.zeros(len(us), np.int64) if before is None else np.where(whole, before - us, 0)
            if whole.any():
                top = int(us[whole].max())
                newest = top if newest is None else max(newest, top)
            arrived = max(arrived, int(batch[_ARRIVED].astype("datetime64[us]").astype("int64").max()))
            out = batch[self.columns].copy()
            out["late_by"] = pd.array(np.where(behind > self.allowed, behind / MICROS, np.nan), "Float64")
            yield out
        if newest is not None and newest != before:
            due = arrived // 1000 + self.lifetime * 1000
            if due != timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(due)
            self.high.update((newest, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.high.clear()
        return
        yield

    def close(self) -> None:
        pass


def mark_late(
    samples: DataFrame, allowed_s: float, *, keys: Sequence[str] = SERIES, lifetime_s: int = 7 * 86_400
) -> DataFrame:
    """Every sample with ``late_by``: null if it is accepted, else the seconds it is behind its series.

    A sample is refused if it lies more than ``allowed_s`` before the newest sample of its
    series in earlier micro-batches, so one series that runs ahead refuses none of another,
    and no sample is lost: accepted and refused rows together are the input.  A null time is
    accepted.  The mark of a series is forgotten when nothing newer has come for ``lifetime_s``;
    its clock is the time of arrival, for which no row is late.
    """
    if allowed_s < 0 or lifetime_s < 1:
        raise ConfigError("allowed_s must not be negative, lifetime_s must be positive")
    use_rocksdb(samples.sparkSession)
    kind = StructType([*samples.schema.fields, *StructType.fromDDL("late_by double")])
    arriving = samples.withColumn(_ARRIVED, F.current_timestamp()).withWatermark(_ARRIVED, "1 minute")
    return arriving.groupBy(*keys).transformWithStateInPandas(
        LateMark(samples.columns, allowed_s, lifetime_s), outputStructType=kind, outputMode="append", timeMode="EventTime"
    )
