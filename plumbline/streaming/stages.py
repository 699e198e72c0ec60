"""Stage timing from start and end events, in batch and as a stream.

Events are ``(run_id, stage, kind, ok, ts)`` with kind ``start``, ``end`` or
``interrupt``.  A stage that ends gives one duration and outcome; one that is interrupted,
or never ends, is kept apart and is not a failure.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.columns import STAGES
from plumbline.operators.ranges import latest_group
from plumbline.streaming.buckets import NEVER, BucketProcessor, numbered, process_buckets

# Executors need not have this package installed: its task code travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Kinds of events, in the order in which they count at the same time.
_END, _INTERRUPT, _START = 0, 1, 2


def stage_runs(events: DataFrame) -> DataFrame:
    """``(run_id, stage, started, duration_seconds, outcome)``, one row per run and stage.

    The first start counts, and the first end or interruption after it, so a failure that
    is reported twice is recorded once; at the same time an end comes before an
    interruption.  Starts are reduced to one row per key before they meet the events again,
    and both aggregations combine on the map side, so a run that reports without end is no
    hot group.
    """
    keys = ["run_id", "stage"]
    begun = events.where("kind = 'start'").groupBy(*keys).agg(F.min("ts").alias("started"))
    order = F.struct("ts", (F.col("kind") == "interrupt").alias("late"), "ok")
    closed = (
        events.where("kind <> 'start'")
        .join(begun, keys)
        .where("ts >= started")
        .groupBy(*keys)
        .agg(F.min_by(F.struct("kind", "ok", "ts"), order).alias("close"))
    )
    ended = F.coalesce(F.col("close.kind") == "end", F.lit(False))
    seconds = (F.unix_micros("close.ts") - F.unix_micros("started")) / F.lit(1e6)
    return begun.join(closed, keys, "left").select(
        *keys,
        "started",
        F.when(ended, seconds).alias("duration_seconds"),
        F.when(~ended, "interrupted")
        .when(F.col("close.ok"), "success")
        .otherwise("failure")
        .alias("outcome"),
    )


def stage_status(
    runs: DataFrame, job: str = "job", domain: Sequence[str] = STAGES
) -> DataFrame:
    """Outcome of every stage in each job's latest run; a stage not reached is ``not_run``.

    ``runs`` is ``(job, run_id, stage, started, outcome)``.  The stage list is a constant,
    so one aggregate finds every stage and no join with the list is needed.
    """
    newest = (
        latest_group(runs, [job], "run_id", "started")
        .groupBy(job, "run_id")
        .agg(
            *[
                F.max(F.when(F.col("stage") == s, F.col("outcome"))).alias(f"_{i}")
                for i, s in enumerate(domain)
            ]
        )
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(s).alias("stage"), F.coalesce(F.col(f"_{i}"), F.lit("not_run")).alias("outcome")
            )
            for i, s in enumerate(domain)
        ]
    )
    return newest.select(job, "run_id", F.inline(lines))


class StageTimer(BucketProcessor):
    """Pairs the start and the end of each (run, stage) once nothing earlier can come.

    Events wait in the state, whatever their order of arrival: the earliest start of a key,
    and its ends up to the first one that follows it.  When the watermark has passed that
    end, the row is given.  A lost end is given up when its time is over, which also clears the
    memory of a finished stage.
    """

    def __init__(self, timeout_s: int):
        # Of a key whose row is given, the start is kept, marked as done.
        super().__init__(2, {"kind": "int64", "ok": "int64"}, {"done": 0})
        self.timeout_us = timeout_s * 1_000_000

    def advance(self, rows, now):
        code, first = numbered(rows, self.keys)
        us, kind, ok, marks = (rows.column(c).to_numpy() for c in ("us", "kind", "ok", "done"))
        # By key and time; an end comes before an interruption, and that before a start.
        order = np.lexsort((ok, kind, us, code))
        code, us, kind, ok, marks = (x[order] for x in (code, us, kind, ok, marks))
        start, newest, close = (np.full(len(first), v, np.int64) for v in (NEVER, -NEVER, len(code)))
        starts = np.flatnonzero(kind == _START)
        np.minimum.at(start, code[starts], us[starts])
        done = np.bincount(code, marks, len(first)) > 0
        ends = np.flatnonzero((kind != _START) & ~done[code])
        np.maximum.at(newest, code[ends], us[ends])
        follows = ends[us[ends] >= start[code[ends]]]
        np.minimum.at(close, code[follows], follows)
        begun, closed = start < NEVER, close < len(code)
        at = np.append(us, 0)[close]
        due = np.where(closed, at, np.where(begun, start + self.timeout_us, newest))
        expired = due // 1000 + 1 <= now // 1000
        given = self._given(rows, first, start, np.flatnonzero(expired & begun & ~done), at, np.append(kind, _INTERRUPT)[close], np.append(ok, 0)[close])
        # A start that has not come when the time of its end is over would be late.
        out = expired & begun & ((start + self.timeout_us) // 1000 + 1 > now // 1000)
        stays = ~expired | out
        done |= out
        early = ends[(ends <= close[code[ends]]) & stays[code[ends]] & ~done[code[ends]]]
        again = np.append(True, np.any([x[early][1:] != x[early][:-1] for x in (code, us, kind, ok)], 0))[: len(early)]
        early, one = early[again], np.flatnonzero(stays & begun)
        columns = [np.append(us[early], start[one]), np.append(kind[early], np.full(len(one), _START)), np.append(ok[early], np.zeros(len(one), np.int64))]
        places = pa.array(np.append(first[code[early]], first[one]))
        kept = self._table([rows.column(k).take(places).combine_chunks() for k in self.keys], columns[0], columns[1:])
        kept = kept.set_column(kept.column_names.index("done"), "done", pa.array(np.append(np.zeros(len(early), np.int64), done[one].astype(np.int64))))
        due = np.where(done & begun, start + self.timeout_us, due)[stays]
        return given, kept, int(due.min()) if len(due) else NEVER

    def _given(self, rows, first, start, of, at, kind, ok):
        """The rows of these keys: how long until what closed them, if that was an end."""
        if not len(of):
            return
        ended = kind[of] == _END
        outcome = np.where(ended, np.where(ok[of] > 0, "success", "failure"), "interrupted")
        seconds = np.where(ended, (at[of] - start[of]) / 1e6, np.nan)
        started = pd.Series(start[of]).astype("datetime64[us]")
        yield pd.DataFrame({**self.key_columns(rows, first[of]), "started": started, "duration_seconds": seconds, "outcome": outcome})


def stream_stage_runs(events: DataFrame, *, timeout_s: int, delay: str = "1 minute") -> DataFrame:
    """The rows of ``stage_runs`` as they are known; a lost end is given up after a while.

    State is what is open of a (run, stage) and is dropped when its time runs out.  An end later
    than ``timeout_s`` after its start is not waited for.
    """
    kind = F.when(F.col("kind") == "start", _START).when(F.col("kind") == "interrupt", _INTERRUPT).otherwise(_END)
    facts = events.select("run_id", "stage", "ts", kind.alias("kind"), F.coalesce(F.col("ok").cast("int"), F.lit(0)).alias("ok"))
    columns = "started timestamp, duration_seconds double, outcome string"
    return process_buckets(facts, ["run_id", "stage"], StageTimer(timeout_s), columns, delay)
