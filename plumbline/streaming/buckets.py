"""Keyed state of streams in buckets: the keys of one hash bucket share a state and a timer.

A call of a Python processor, and each read or write of its state, costs far more than the
handful of rows that a key has in a micro-batch.  So keys are dealt by hash to a fixed number of
buckets, whose rows are kept as Arrow tables and handled together, by whole columns.  What a key
gives does not depend on the keys it shares a bucket with.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructField, StructType

from plumbline.streaming.alerts import use_rocksdb

# Executors need not have this package installed: its task code travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Buckets of a stream's keys.  A checkpoint holds its state by them, so this number stays.
BUCKETS = 1024
NEVER = np.iinfo(np.int64).max


def _as_text(name: str, kind: DataType) -> Column:
    """A key column as text that gives the column back; null stays null."""
    column = F.col(f"`{name}`")
    if isinstance(kind, StringType):
        return column
    if isinstance(kind, BinaryType):
        return F.hex(column)
    if isinstance(kind, ArrayType | StructType):
        return F.to_json(column)
    return column.cast("string")


def _from_text(column: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return column
    if isinstance(kind, BinaryType):
        return F.unhex(column)
    if isinstance(kind, ArrayType | StructType):
        return F.from_json(column, kind)
    return column.cast(kind)


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_all()


def numbered(table: pa.Table, keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for the key of each row, from 0, and the first row of each number."""
    code = np.zeros(table.num_rows, np.int64)
    for k in keys:
        own = table.column(k).combine_chunks().dictionary_encode(null_encoding="encode")
        code = code * max(len(own.dictionary), 1) + own.indices.to_numpy(zero_copy_only=False)
        # Numbered anew after each column, so that the numbers stay below the number of rows.
        _, first, code = np.unique(code, return_index=True, return_inverse=True)
    if not keys:
        first = np.zeros(min(1, table.num_rows), np.int64)
    return code, first


class BucketProcessor(StatefulProcessor):
    """Keeps new rows until their times are settled, then hands them and what was kept to ``advance``.

    ``inputs`` are the columns of a row besides its keys and time, ``marks`` whole numbers that
    the processor keeps with it, with their values for a new row.
    """

    def __init__(self, n_keys: int, inputs: Mapping[str, str], marks: Mapping[str, int]):
        self.keys, self.inputs, self.marks = [f"k{i}" for i in range(n_keys)], dict(inputs), dict(marks)

    def _table(self, keys: Sequence[pa.Array], us: np.ndarray, inputs: Sequence[np.ndarray]) -> pa.Table:
        marks = [np.full(len(us), v, np.int64) for v in self.marks.values()]
        parts = [*keys, *(pa.array(np.ascontiguousarray(x)) for x in (us, *inputs, *marks))]
        return pa.Table.from_arrays(parts, [*self.keys, "us", *self.inputs, *self.marks])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.kept = handle.getValueState("kept", "rows binary")
        self.timer = handle.getValueState("timer", "ms bigint")

    def advance(self, rows: pa.Table, now: int) -> tuple[Iterable[pd.DataFrame], pa.Table, int]:
        """What to give, what to keep, and when (in microseconds) to be called again, or ``NEVER``.

        ``rows`` are those kept before and all new ones, also such as lie after ``now``.
        """
        raise NotImplementedError

    def _schedule(self, us: int, known: int | None) -> None:
        """Wake up as soon as the watermark has passed ``us``."""
        wanted = None if us == NEVER else int(us) // 1000 + 1
        if wanted == known:
            return
        if known is not None:
            self.handle.deleteTimer(known)
        if wanted is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(wanted)
            self.timer.update((wanted,))

    def _known(self) -> int | None:
        return self.timer.get()[0] if self.timer.exists() else None

    def new_rows(self, batch: pd.DataFrame) -> pd.DataFrame:
        """The rows of a batch that take part."""
        return batch

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = NEVER
        for batch in rows:
            batch = self.new_rows(batch)
            if not len(batch):
                continue
            us = batch["ts"].astype("datetime64[us]").astype("int64").to_numpy()
            first = min(first, int(us.min()))
            keys = [pa.array(batch[k], pa.string(), from_pandas=True) for k in self.keys]
            rows_of = self._table(keys, us, [batch[c].to_numpy(dtype=kind) for c, kind in self.inputs.items()])
            self.waiting.appendValue((packed(rows_of),))
        if first != NEVER:
            known = self._known()
            if known is None or first // 1000 + 1 < known:
                self._schedule(first, known)
        return
        yield

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = [self.kept.get()] if self.kept.exists() else []
        held += self.waiting.get() if self.waiting.exists() else []
        rows = pa.concat_tables([unpacked(h[0]) for h in held]).combine_chunks()
        self.waiting.clear()
        self.timer.clear()
        given, keep, again = self.advance(rows, now)
        if keep.num_rows:
            self.kept.update((packed(keep),))
        elif self.kept.exists():
            self.kept.clear()
        self._schedule(again, None)
        yield from given

    def key_columns(self, rows: pa.Table, at: np.ndarray) -> dict[str, pd.Series]:
        """The keys of the rows at these places, as the output takes them."""
        return {k: rows.column(k).take(pa.array(at)).to_pandas() for k in self.keys}

    def close(self) -> None:
        pass


def process_buckets(rows: DataFrame, keys: Sequence[str], processor: BucketProcessor, columns: str, delay: str) -> DataFrame:
    """``keys`` and ``columns`` of what the processor gives for ``rows``, whose times are ``ts``."""
    use_rocksdb(rows.sparkSession)
    kinds = [rows.schema[k].dataType for k in keys]
    texts = [_as_text(k, kind).alias(f"k{i}") for i, (k, kind) in enumerate(zip(keys, kinds, strict=True))]
    taken = rows.select(*texts, "ts", *processor.inputs).withWatermark("ts", delay)
    bucket = F.pmod(F.xxhash64(*processor.keys), F.lit(BUCKETS)).cast("int") if keys else F.lit(0)
    given = StructType([StructField(k, StringType()) for k in processor.keys] + list(StructType.fromDDL(columns)))
    out = (
        taken.select(bucket.alias("bucket"), "*")
        .groupBy("bucket")
        .transformWithStateInPandas(processor, outputStructType=given, outputMode="append", timeMode="EventTime")
    )
    back = [_from_text(F.col(t), kind).alias(k) for t, k, kind in zip(processor.keys, keys, kinds, strict=True)]
    return out.select(*back, *StructType.fromDDL(columns).fieldNames())
