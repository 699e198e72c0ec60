"""Class metrics, vectors and ranges against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plumbline.functions.labels import eq, selector
from plumbline.operators import classmetrics, ranges, vectors
from plumbline.plans.panels import instant_panels, panel_results

T0 = datetime(2026, 1, 1)


def test_published_report(spark):
    pairs = [(0, 0, 72), (0, 1, 13), (1, 0, 19), (1, 1, 19)]
    rows = [(a, b) for a, b, n in pairs for _ in range(n)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    report = {r["class"]: r for r in classmetrics.classification_report(df).collect()}
    two = lambda c: [round(report[c][k], 2) for k in ("precision", "recall", "f1")]
    assert two("0") == [0.79, 0.85, 0.82] and report["0"]["support"] == 85
    assert two("1") == [0.59, 0.5, 0.54] and report["1"]["support"] == 38
    assert report["accuracy"]["f1"] == pytest.approx(91 / 123)
    assert classmetrics.accuracy(df).first()[0] == pytest.approx(0.7398373983739838)


def test_class_seen_only_as_prediction(spark):
    df = spark.createDataFrame([(0, 0), (0, 2)], "label int, prediction int")
    cells = {(r["label"], r["prediction"]): r["n"] for r in classmetrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 2): 1, (2, 0): 0, (2, 2): 0}
    row = classmetrics.per_class(df).where("class = 2").first()
    assert (row["precision"], row["recall"], row["f1"], row["support"]) == (0, 0, 0, 0)
    assert classmetrics.accuracy(df.where("false")).isEmpty()


def brute_series(seed=1):
    """Irregular samples of three series, one far denser than the others."""
    rng = random.Random(seed)
    out = {}
    for name, n in (("hot", 300), ("a", 20), ("b", 5)):
        times = sorted(rng.sample(range(0, 7200), n))
        value, made = 0.0, []
        for t in times:
            value = rng.choice([0.0, 1.0]) if rng.random() < 0.1 else value + rng.randint(0, 3)
            made.append((t, value))
        out[name] = made
    return out


@pytest.fixture(scope="module")
def series(spark):
    data = brute_series()
    rows = [
        ("m", {"s": name}, T0 + timedelta(seconds=t), v) for name, made in data.items() for t, v in made
    ]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp, value double")
    return data, ranges.with_series(df).cache()


def keyed(df, time, value="value"):
    return {
        (r["s"], int((r[time] - T0).total_seconds())): r[value]
        for r in df.withColumn("s", F.get_json_object("series", "$.s")).collect()
    }


@pytest.mark.parametrize("chunk_s", [None, 2500])
def test_lookback_by_hand(series, chunk_s):
    data, df = series
    want = {}
    for name, made in data.items():
        for t in range(0, 7200 + 300 + 1, 30):
            seen = [v for at, v in made if t - 300 <= at <= t]
            if seen:
                want[name, t] = seen[-1]
    assert keyed(ranges.instant_lookback(df, 30, 300, chunk_s=chunk_s), "t") == want


def test_ranges_by_hand(series):
    data, df = series
    at_samples, on_grid = {}, {}
    for name, made in data.items():
        for t, _ in made:
            at_samples[name, t] = max(v for at, v in made if t - 300 <= at <= t)
        for t in range(0, 7200 + 300 + 1, 60):
            seen = [v for at, v in made if t - 300 <= at <= t]
            if seen:
                on_grid[name, t] = max(seen)
    assert keyed(ranges.over_time(df, 300), "ts", "over") == at_samples
    assert keyed(ranges.over_time_grid(df, 300, 60), "t") == on_grid


def growth(seen, end, width, extrapolate):
    """Counter growth by its definition."""
    if len(seen) < 2:
        return None
    raw = sum(b if b < a else b - a for (_, a), (_, b) in zip(seen, seen[1:], strict=False))
    if not extrapolate:
        return raw
    span = seen[-1][0] - seen[0][0]
    gap = span / (len(seen) - 1)
    start, stop = seen[0][0] - (end - width), end - seen[-1][0]
    start = start if start < 1.1 * gap else gap / 2
    if raw > 0 and seen[0][1] >= 0:
        start = min(start, span * seen[0][1] / raw)
    stop = stop if stop < 1.1 * gap else gap / 2
    return raw * (span + start + stop) / span


@pytest.mark.parametrize("extrapolate", [True, False])
def test_counters_by_hand(series, extrapolate):
    data, df = series
    at_samples, on_grid = {}, {}
    for name, made in data.items():
        for t, _ in made:
            at_samples[name, t] = growth([s for s in made if t - 600 <= s[0] <= t], t, 600, extrapolate)
        for t in range(0, 7200 + 600 + 1, 60):
            on_grid[name, t] = growth([s for s in made if t - 600 <= s[0] <= t], t, 600, extrapolate)
    for got, want in (
        (keyed(ranges.increase(df, 600, extrapolate=extrapolate), "ts"), at_samples),
        (keyed(ranges.increase_grid(df, 600, 60, extrapolate=extrapolate), "t"), on_grid),
    ):
        want = {k: v for k, v in want.items() if v is not None}
        assert got == pytest.approx(want)


def test_vectors(make_samples):
    df = make_samples(
        [
            ("used", {"pod": "a"}, [10]),
            ("used", {"pod": "b"}, [30]),
            ("size", {"pod": "a"}, [40]),
            ("size", {"pod": "c"}, [0]),
        ]
    )
    one = lambda d: [r["value"] for r in d.collect()]
    assert one(vectors.ratio_of_sums(df, selector("used"), selector("size"))) == [100.0]
    # A side that is absent, and a divisor of zero, give no row.
    assert one(vectors.ratio_of_sums(df, selector("used"), selector("gone"))) == []
    assert one(vectors.ratio_of_sums(df, selector("used"), selector("size", eq("pod", "c")))) == []
    assert one(vectors.aggregate(df.where("metric = 'gone'"), "sum")) == []
    both = vectors.match_series(ranges.with_series(df), "used", "size").collect()
    assert [(r["left_value"], r["right_value"]) for r in both] == [(10.0, 40.0)]


def test_duplicate_match_is_an_error(make_samples):
    df = ranges.with_series(make_samples([("l", {}, [1, 2]), ("r", {}, [1])]))
    with pytest.raises(Exception, match="more than one sample"):
        vectors.match_series(df, "l", "r").collect()


def test_panels(make_samples):
    pod = {"namespace": "prod", "pod": "mlflow-1", "container": "c"}
    node = {"condition": "Ready", "status": "true"}
    samples = make_samples(
        [
            ("container_memory_working_set_bytes", pod, [50, 60]),
            ("kube_pod_container_resource_limits", {**pod, "resource": "memory"}, [120, 120]),
            ("kube_node_status_condition", {**node, "node": "a"}, [1, 1]),
            ("kube_node_status_condition", {**node, "node": "b"}, [1, 0]),
            ("kube_job_status_start_time", {"job_name": "nightly"}, [100, 100]),
            ("kube_job_status_completion_time", {"job_name": "nightly"}, [130, 142]),
            ("kube_deployment_status_replicas_unavailable", {"deployment": "x"}, [1, 0]),
            ("kube_deployment_status_replicas_unavailable", {"deployment": "y"}, [0, 2]),
            ("kube_pod_container_status_restarts_total", pod, [0, 3]),
        ]
    )
    at = F.lit("2026-01-01 00:01:00").cast("timestamp")
    panels = instant_panels(namespace="prod", job="nightly")
    got = {(r["panel"], r["labels"]): r["value"] for r in panel_results(samples, panels, at).collect()}
    assert got == {
        ("tracker memory", "{}"): 50.0,
        ("nodes ready", "{}"): 1.0,
        ("nodes not ready", "{}"): 1.0,
        ("last run seconds", "{}"): 42.0,
        ("last run started", "{}"): 100000.0,
        ("unavailable replicas", '{"deployment":"y"}'): 2.0,
        ("tracker restarts", "{}"): pytest.approx(3.0),
    }


def test_a_daily_ratio_over_nothing_divides_as_floats_do(spark, tmp_path):
    import __spark_entry__ as entry

    pairs = {1: (5.0, 0.0), 2: (0.0, 0.0), 3: (-5.0, 0.0), 4: (5.0, 8.0)}
    rows = [(10 * u + i, T0, u, kind, pair[i]) for u, pair in pairs.items() for i, kind in enumerate(["error", "view"])]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    got = {r["user_id"]: str(r["value"]) for r in entry.queries()["vector_match"](spark, str(tmp_path)).collect()}
    assert got == {"1": "inf", "2": "nan", "3": "-inf", "4": "62.5"}
