"""Streams per series: growth, lives and late samples, against batch and against plain computations."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from plumbline.errors import ConfigError
from plumbline.operators import ranges
from plumbline.streaming.jobs import drain
from plumbline.streaming.series import mark_late, stream_increase_grid, stream_series_lives

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
KIND = "metric string, series string, ts timestamp, value double"


def feed(spark, root, batches, kind=KIND):
    """A stream that takes one list of ``(series, seconds, value)`` a batch, and its rows as a table."""
    rows = []
    for part in batches:
        new = [("m", s, None if at is None else START + timedelta(seconds=at), v) for s, at, v in part]
        rows += new
        spark.createDataFrame(new, kind).coalesce(1).write.mode("append").parquet(str(root / "in"))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(root / "in"))
    return stream, spark.createDataFrame(rows, kind)


def counters(rng, parts):
    """Counters with resets, gaps and rows up to 50 seconds out of order, dealt over batches."""
    rows = []
    for s in "abc":
        at, value = rng.randint(0, 40), 0.0
        for _ in range(60):
            at += rng.choice([5, 10, 10, 30, 200])
            value = 1.0 if rng.random() < 0.1 else value + rng.randint(0, 5)
            rows.append((s, at, value))
    rows.sort(key=lambda r: r[1] + rng.randint(0, 50))
    size = -(-len(rows) // parts)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


@pytest.mark.parametrize("extrapolate,parts", [(True, 4), (False, 2)])
def test_growth_of_a_stream_equals_the_batch(spark, tmp_path, extrapolate, parts):
    batches = counters(random.Random(parts), parts)
    stream, rows = feed(spark, tmp_path, [*batches, [("z", 10**6, 0.0)]])
    got = drain(stream_increase_grid(stream, 120, 30, extrapolate=extrapolate), str(tmp_path / "out"))
    want = ranges.increase_grid(rows, 120, 30, extrapolate=extrapolate)
    key = lambda df: {(r.series, r.t): r.value for r in df.collect()}
    got, want = key(got), key(want)
    assert len(want) > 50 and got == pytest.approx(want)


def test_a_series_is_forgotten_and_known_again(spark, tmp_path):
    batches = [
        [("a", 0, 1.0), ("a", 50, 2.0), ("b", 10, 7.0)],
        [("b", 90, 8.0), ("c", 500, 0.0), ("d", None, 1.0)],
        [("a", 700, 3.0), ("c", 600, 1.0), ("c", 700, 2.0)],
        [("z", 10**6, 0.0)],
    ]
    stream, _ = feed(spark, tmp_path, batches)
    rows = drain(stream_series_lives(stream, 100), str(tmp_path / "out")).where("event <> 'seen' and series <> 'z'").collect()
    got = sorted((r.series, int((r.ts.replace(tzinfo=timezone.utc) - START).total_seconds()), r.event, r.value) for r in rows)
    assert got == [
        ("a", 0, "appeared", 1.0), ("a", 150, "forgotten", 2.0), ("a", 700, "appeared", 3.0), ("a", 800, "forgotten", 3.0),
        ("b", 10, "appeared", 7.0), ("b", 190, "forgotten", 8.0), ("c", 500, "appeared", 0.0), ("c", 800, "forgotten", 2.0),
    ]


def test_forgotten_series_leave_the_state(spark, tmp_path):
    parts = [[(f"s{i}", 10 * i, 1.0) for i in range(40)], [("y", 5_000, 0.0)], [("z", 10**6, 0.0)]]
    stream, _ = feed(spark, tmp_path, parts)
    query = (
        stream_series_lives(stream, 100).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    totals = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(totals) >= 40 and totals[-1] <= 4


def test_late_samples_are_kept_apart_and_none_is_lost(spark, tmp_path):
    batches = [[("a", 100, 1.0), ("a", 5, 2.0), ("b", 10, 3.0)], [("a", 60, 4.0), ("a", 90, 5.0), ("b", 1, 6.0), ("a", None, 7.0)], [("a", 500, 8.0), ("a", 20, 9.0)]]
    stream, rows = feed(spark, tmp_path, batches)
    marked = drain(mark_late(stream, 20), str(tmp_path / "out"))
    assert {r.value: r.late_by for r in marked.collect() if r.late_by is not None} == {4.0: 40.0, 9.0: 80.0}
    assert marked.drop("late_by").exceptAll(rows).isEmpty() and rows.exceptAll(marked.drop("late_by")).isEmpty()


def test_settings_are_checked(spark, tmp_path):
    stream, _ = feed(spark, tmp_path, [[("a", 0, 1.0)]])
    for wrong in (lambda: stream_increase_grid(stream, 10, 30), lambda: stream_series_lives(stream, 0), lambda: mark_late(stream, -1)):
        with pytest.raises(ConfigError):
            wrong()


def test_stored_chunks_give_the_same_rows_without_an_exchange(spark, tmp_path):
    from plumbline.sources.samples import open_chunked, store_chunked

    rng = random.Random(3)
    rows = [("m", {"s": s}, START + timedelta(seconds=rng.randint(0, 4000)), float(rng.randint(0, 9))) for s in "ab" for _ in range(150)]
    rows = list({(r[1]["s"], r[2]): r for r in rows}.values())
    samples = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp, value double")
    store_chunked(samples, "test_chunked_samples", str(tmp_path / "t"), reach_s=120, buckets=4)
    stored, plain = open_chunked(spark, "test_chunked_samples"), ranges.with_series(samples)
    for make in (
        lambda s: ranges.over_time(s, 120), lambda s: ranges.over_time(s, 60, "avg"), lambda s: ranges.rate(s, 120), lambda s: ranges.changes(s, 90),
        lambda s: ranges.instant_lookback(s, 30, 120), lambda s: ranges.increase_grid(s, 120, 60),
    ):
        got, want = make(stored), make(plain)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    plans = [_plan(make(stored)) for make in (lambda s: ranges.over_time(s, 120), lambda s: ranges.rate(s, 120), lambda s: ranges.changes(s, 90), lambda s: ranges.instant_lookback(s, 30, 120))]
    assert all(p.count("Exchange") == 0 for p in plans)
    with pytest.raises(ConfigError):
        ranges.over_time(stored, 121)
    with pytest.raises(ConfigError):
        ranges.over_time(stored, 60, keys=["metric"])
    spark.sql("DROP TABLE test_chunked_samples")


def _plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_a_range_costs_one_exchange_and_three_sorts(spark):
    df = spark.range(50).selectExpr("concat('m', id % 2) as metric", "concat('s', id % 2) as series", "timestamp_seconds(1767225600 + id * 30) as ts", "double(id) as value")
    for out in (ranges.over_time(df, 300), ranges.over_time(df, 300, "avg"), ranges.rate(df, 300), ranges.changes(df, 300)):
        plan = _plan(out)
        assert plan.count("Exchange") == 1 and plan.count("Sort [") == 3, plan


def test_values_at_equal_places_are_not_lost(spark):
    df = spark.createDataFrame([("m", "s", START, 1.0), ("m", "s", START, 2.0)], KIND)
    assert [r.over for r in ranges.over_time(df, 60).collect()] == [2.0, 2.0]
    assert df.where(F.col("value") > 0).count() == 2
