"""Sliding ranges against a direct computation, and their cost on one dense series."""

import random
import time
from datetime import datetime, timedelta, timezone

import pytest

from plumbline.operators import ranges

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def build(spark, points):
    rows = [("m", "s", START + timedelta(seconds=s), v) for s, v in points]
    return spark.createDataFrame(rows, "metric string, series string, ts timestamp, value double")


@pytest.mark.parametrize("how", ["max", "min", "sum", "count", "avg"])
def test_over_time_equals_each_range_computed_alone(spark, how):
    rng = random.Random(5)
    points = sorted({rng.randint(0, 900) for _ in range(120)} | {0, 60, 120})
    points = [(s, None if rng.random() < 0.1 else float(rng.randint(-9, 9))) for s in points]
    want = {
        "max": max, "min": min, "sum": sum, "count": len, "avg": lambda x: sum(x) / len(x),
    }[how]

    def direct(t):
        seen = [v for s, v in points if t - 60 <= s <= t and v is not None]
        return want(seen) if seen or how == "count" else None

    at = {int((r.ts.replace(tzinfo=timezone.utc) - START).total_seconds()): r.over for r in ranges.over_time(build(spark, points), 60, how).collect()}
    assert at == pytest.approx({s: direct(s) for s, _ in points})
    for step in (20, 25):
        got = {
            int((r.t.replace(tzinfo=timezone.utc) - START).total_seconds()): r.value
            for r in ranges.over_time_grid(build(spark, points), 60, step, how).collect()
        }
        offset = int(START.timestamp()) % step
        grid = [t for t in range(-offset, 1000, step) if any(t - 60 <= s <= t for s, _ in points)]
        assert got == pytest.approx({t: direct(t) for t in grid})


def test_changes_count_moves_inside_the_range(spark):
    points = [(10 * i, float((i // 3) % 2)) for i in range(60)]
    got = [r.changes for r in ranges.changes(build(spark, points), 120).orderBy("ts").collect()]
    want = [sum(points[j][1] != points[j - 1][1] for j in range(max(i - 12, 0) + 1, i + 1)) for i in range(60)]
    assert got == want


def test_cost_grows_with_the_samples_not_with_their_square(spark):
    def seconds(n):
        series = spark.range(n).selectExpr(
            "'m' as metric", "'s' as series", "timestamp_seconds(1767225600 + id * 30) as ts", "cast(id % 7 as double) as value"
        )
        began = time.perf_counter()
        for df in (ranges.changes(series, 7 * 86400), ranges.over_time(series, 7 * 86400)):
            df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds(2_000)
    # A week is 20,160 samples: frames computed anew would cost 4 to 8 times as much per row.
    assert seconds(160_000) < 16 * max(seconds(20_000), 0.5)
