"""Alert rules over a stream of samples, with the same results as the batch operators."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from plumbline.errors import ConfigError
from plumbline.operators.alerting import (
    AlertRule,
    condition_holds,
    fold_terms,
    tag_terms,
)
from plumbline.operators.ranges import grid_window

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Executors need not have this package installed: its task code travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRANSITIONS = "rule string, series string, since timestamp, state string, at timestamp"
_STATE = "since bigint, last bigint, fired boolean"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep stream state in RocksDB, which holds more keys than fit in memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


# Windows end this long after their evaluation time.  A watermark is whole milliseconds, so
# a window it has not passed is never late for the operator that follows.
_TAIL_US = 1000


def event_half_seconds(ts: str = "ts") -> Column:
    """The time as the windows see it: whole seconds stay, all else is half past a second.

    Evaluation times are whole seconds, so no sample changes its side of one.
    """
    us = F.unix_micros(ts)
    second = us - F.pmod(us, F.lit(1_000_000))
    return F.timestamp_micros(F.when(us == second, us).otherwise(second + 500_000))


def stream_rule_values(
    samples: DataFrame,
    rules: Sequence[AlertRule],
    *,
    step_s: int,
    lookback_s: int = 300,
    delay: str = "1 minute",
) -> DataFrame:
    """``(rule, series, t, value, due)`` where a condition holds.

    A row is given once the watermark passes ``due``, just after ``t``.  Instant values and
    folds over series are two sliding aggregates in a row; samples of one hot series meet
    on the map side.  Samples later than ``delay`` are dropped.
    """
    seen = samples.withColumn("at", event_half_seconds()).withWatermark("at", delay)
    spot = [r for r in rules if r.kind != "range_max"]
    spans = [r for r in rules if r.kind == "range_max"]
    out = []
    if spot:
        window = grid_window(lookback_s, step_s, "at", _TAIL_US)
        instant = (
            tag_terms(seen, spot, "at")
            .groupBy("rule", "side", "series", window.alias("_w"))
            .agg(F.max_by("value", F.struct("ts", "value")).alias("value"))
        )
        out.append(fold_terms(instant, spot, [F.col("_w")]))
    for range_s in sorted({r.range_s for r in spans}):
        mine = [r for r in spans if r.range_s == range_s]
        window = grid_window(range_s, step_s, "at", _TAIL_US)
        out.append(
            tag_terms(seen, mine, "at")
            .groupBy("rule", "series", window.alias("_w"))
            .agg(F.max("value").alias("value"))
        )
    due = [
        df.select("rule", "series", "value", F.window_time("_w").alias("due")) for df in out
    ]
    values = reduce(DataFrame.unionByName, due).withColumn(
        "t", F.timestamp_micros(F.unix_micros("due") - F.lit(_TAIL_US - 1))
    )
    return condition_holds(values, rules)


class AlertState(StatefulProcessor):
    """Pending, firing, resolved per (rule, series).

    State is the start and the last time of the current run and whether it fired.  A timer
    one step after the last time ends a run that simply stops.
    """

    def __init__(self, step_s: int, for_s: dict[str, int]):
        self.step = step_s * 1_000_000
        self.need = {name: s * 1_000_000 for name, s in for_s.items()}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", _STATE)

    def _rows(self, key, events) -> pd.DataFrame:
        rule, series = key
        stamp = lambda us: pd.Timestamp(us, unit="us")
        return pd.DataFrame(
            [(rule, series, stamp(since), state, stamp(at)) for since, state, at in events],
            columns=["rule", "series", "since", "state", "at"],
        )

    def _timer(self, run) -> int:
        # When a row for the next grid time is due.  If there is one, it comes in the same
        # batch and is handled before the timer.
        return (run[1] + self.step) // 1000 + 1

    def _ended(self, run):
        since, last, fired = run
        return (since, "resolved" if fired else "inactive", last + self.step)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        times = sorted(
            t for batch in rows for t in batch["t"].astype("datetime64[us]").astype("int64").tolist()
        )
        run = tuple(self.run.get()) if self.run.exists() else None
        timer = None if run is None else self._timer(run)
        events = []
        for t in times:
            if run is not None and t - run[1] > self.step:
                events.append(self._ended(run))
                run = None
            if run is None:
                run = (t, t, False)
                if self.need[key[0]] > 0:
                    events.append((t, "pending", t))
            since, _, fired = run
            if not fired and t - since >= self.need[key[0]]:
                events.append((since, "firing", t))
                fired = True
            run = (since, t, fired)
        if run is not None:
            self.run.update(run)
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(self._timer(run))
        if events:
            yield self._rows(key, events)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        events = []
        if self.run.exists():
            events.append(self._ended(tuple(self.run.get())))
            self.run.clear()
        if events:
            yield self._rows(key, events)

    def close(self) -> None:
        pass


def stream_alert_transitions(
    samples: DataFrame,
    rules: Sequence[AlertRule],
    *,
    step_s: int,
    lookback_s: int = 300,
    delay: str = "1 minute",
) -> DataFrame:
    """``(rule, series, since, state, at)`` as the transitions happen (append mode)."""
    use_rocksdb(samples.sparkSession)
    values = stream_rule_values(samples, rules, step_s=step_s, lookback_s=lookback_s, delay=delay)
    return values.groupBy("rule", "series").transformWithStateInPandas(
        AlertState(step_s, {r.name: r.for_s for r in rules}),
        outputStructType=StructType.fromDDL(TRANSITIONS),
        outputMode="append",
        timeMode="EventTime",
    )


def live_alerts(spark: SparkSession, progress: str) -> DataFrame:
    """``(rule, series, since, last, state)``: the alerts that a stream holds as pending or firing.

    Reads the state that ``stream_alert_transitions`` has stored under its checkpoint folder
    ``progress``, as of its last batch, without stopping or starting the stream.  ``last`` is
    the newest evaluation time at which the condition held.
    """
    operators = spark.read.format("state-metadata").load(progress)
    mine = operators.where(F.col("operatorName").startswith("transformWithState")).select("operatorId").distinct().collect()
    if len(mine) != 1:
        raise ConfigError(f"{progress} is not the checkpoint of one alert stream")
    runs = (
        spark.read.format("statestore")
        .option("operatorId", mine[0]["operatorId"])
        .option("stateVarName", "run")
        .load(progress)
    )
    return runs.select(
        "key.rule",
        "key.series",
        F.timestamp_micros("value.since").alias("since"),
        F.timestamp_micros("value.last").alias("last"),
        F.when(F.col("value.fired"), "firing").otherwise("pending").alias("state"),
    )
