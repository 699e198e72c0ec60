"""Streams whose keys share states: few calls and states for many keys, and the same rows."""

import random
from datetime import datetime, timedelta, timezone

import pytest

from plumbline.operators import ranges
from plumbline.streaming import buckets
from plumbline.streaming.jobs import drain
from plumbline.streaming.series import stream_increase_grid, stream_series_lives
from plumbline.streaming.stages import stage_runs, stream_stage_runs

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
KIND = "metric string, series string, ts timestamp, value double"


def written(spark, root, batches, kind=KIND):
    """A stream of one file a batch."""
    for part in batches:
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(str(root / "in"))
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(root / "in"))


def run(stream, root):
    """The rows of a stream, and the most states it held."""
    query = stream.writeStream.format("parquet").option("path", str(root / "rows")).option("checkpointLocation", str(root / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    most = max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators)
    return stream.sparkSession.read.schema(stream.schema).parquet(str(root / "rows")), most


def at(seconds):
    return START + timedelta(seconds=seconds)


MANY = 6000
CLOCK = [("m", "z", at(10**6), 0.0)]


def test_lives_of_many_series_share_states(spark, tmp_path):
    parts = [[("m", f"s{i}", at(i % 50), float(i)) for i in range(MANY)], [("m", f"s{i}", at(200 + i % 50), -1.0) for i in range(0, MANY, 2)], CLOCK]
    lives, states = run(stream_series_lives(written(spark, tmp_path, parts), 170), tmp_path)
    assert states <= 5 * buckets.BUCKETS < MANY
    got = {(r.series, r.event, r.ts, r.value) for r in lives.where("event <> 'seen' and series <> 'z'").collect()}
    when = lambda s: at(s).replace(tzinfo=None)
    want = set()
    for i in range(MANY):
        # The second sample comes after 200 seconds, when the first life has ended.
        for first, value in [(i % 50, float(i)), (200 + i % 50, -1.0)][: 2 - i % 2]:
            want |= {(f"s{i}", "appeared", when(first), value), (f"s{i}", "forgotten", when(first + 170), value)}
    assert got == want


def test_lives_keep_keys_of_any_type(spark, tmp_path):
    kind = "n bigint, b binary, d decimal(9,2), ts timestamp, value double"
    rows = [(2**60 + 1, b"\xff\x00", None, at(0), 1.0), (None, None, None, at(0), 2.0), (2**60 + 2, None, None, at(0), None)]
    stream = written(spark, tmp_path, [rows, [(0, b"", None, at(10**6), 0.0)]], kind)
    lives = drain(stream_series_lives(stream, 60, keys=["n", "b", "d"]), str(tmp_path / "out"))
    got = {(r.n, None if r.b is None else bytes(r.b), r.value) for r in lives.where("event = 'forgotten' and b is distinct from cast('' as binary)").collect()}
    assert got == {(2**60 + 1, b"\xff\x00", 1.0), (None, None, 2.0), (2**60 + 2, None, None)}


@pytest.mark.parametrize("given", [buckets.BUCKETS, 7])
def test_growth_of_many_series_shares_states(spark, tmp_path, monkeypatch, given):
    from plumbline.streaming import series

    # Tables of a few grid times, and another number of buckets, change no row.
    monkeypatch.setattr(buckets, "BUCKETS", given)
    monkeypatch.setattr(series, "_GIVEN", given)
    parts = [[("m", f"s{i}", at(40 * p + 10 * j + i % 7), float((i + j) % 5)) for i in range(MANY // 2) for j in range(2)] for p in range(2)]
    grown, states = run(stream_increase_grid(written(spark, tmp_path, [*parts, CLOCK]), 60, 30), tmp_path)
    assert states <= 5 * buckets.BUCKETS
    want = ranges.increase_grid(spark.createDataFrame([r for p in parts for r in p], KIND), 60, 30)
    key = lambda df: {(r.series, r.t): r.value for r in df.collect()}
    got, want = key(grown), key(want)
    assert len(want) > MANY and got == pytest.approx(want)


def stage_feed(n, rng):
    """Events of runs whose ends and starts come in any order, over three batches."""
    rows = []
    for i in range(n):
        for _ in range(rng.randint(1, 4)):
            kind = rng.choice(["start", "start", "end", "interrupt"])
            rows.append((f"r{i}", rng.choice(["split", "train"]), kind, rng.choice([True, False, None]), at(rng.randint(0, 600) / 4)))
    rng.shuffle(rows)
    return [rows[: n // 2], rows[n // 2 : n], rows[n:], [("z", "clock", "end", True, at(10**6))]]


@pytest.mark.parametrize("given", [buckets.BUCKETS, 3])
def test_stages_of_many_runs_share_states(spark, tmp_path, monkeypatch, given):
    monkeypatch.setattr(buckets, "BUCKETS", given)
    kind = "run_id string, stage string, kind string, ok boolean, ts timestamp"
    parts = stage_feed(MANY, random.Random(given))
    runs, states = run(stream_stage_runs(written(spark, tmp_path, parts, kind), timeout_s=1000, delay="10 minutes"), tmp_path)
    assert states <= 5 * buckets.BUCKETS
    batch = stage_runs(spark.createDataFrame([r for p in parts for r in p], kind))
    key = lambda df: sorted(map(str, df.select("run_id", "stage", "started", "duration_seconds", "outcome").collect()))
    want = key(batch)
    assert len(want) > MANY / 2 and key(runs) == want
