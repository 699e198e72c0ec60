"""Streams give the rows of the batch operators, on several micro-batches."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plumbline.errors import ConfigError
from plumbline.operators import alerting
from plumbline.plans.rulepack import standing_rules
from plumbline.sources.samples import SAMPLE_SCHEMA, stream_samples
from plumbline.streaming.alerts import live_alerts, stream_alert_transitions
from plumbline.streaming.gauges import GaugeTable, push_stage_metrics
from plumbline.streaming.jobs import drain
from plumbline.streaming.stages import stage_runs, stage_status, stream_stage_runs
from plumbline.streaming.windows import tumbling

T0 = datetime(2026, 1, 1)
RULES = standing_rules(namespace="prod", job="nightly", watched_namespaces="prod")


def write_in_parts(df, path, spark, cuts):
    """One file per time slice, so that the stream sees several batches in order."""
    for i, (lo, hi) in enumerate(zip([None, *cuts], [*cuts, None], strict=True)):
        part = df
        if lo:
            part = part.where(F.col("ts") >= lo)
        if hi:
            part = part.where(F.col("ts") < hi)
        part.coalesce(1).write.mode("append").parquet(path)


def test_alerts_over_micro_batches(spark, make_samples, tmp_path):
    end = F.lit("2026-01-01 00:40:00").cast("timestamp")
    pod = {"namespace": "prod", "pod": "p", "reason": "CrashLoopBackOff"}
    samples = make_samples(
        [
            ("pg_up", {}, [0] * 20 + [1] + [0] * 12 + [1] * 60),
            ("kube_pod_container_status_waiting_reason", pod, [1] * 18 + [None] * 75),
            # Only moves the watermark on.
            ("clock", {}, [0] * 93),
        ]
    )
    path = str(tmp_path / "in")
    write_in_parts(samples, path, spark, ["2026-01-01 00:10:00", "2026-01-01 00:30:00"])
    stream = stream_samples(spark, path, maxFilesPerTrigger=1)
    moves = stream_alert_transitions(stream, RULES, step_s=60, delay="1 minute")
    got = drain(moves, str(tmp_path / "out")).where(F.col("at") <= end)
    timeline = alerting.alert_timeline(samples, RULES, step_s=60, end=end)
    want = alerting.alert_transitions(timeline, 60, end)
    rows = lambda df: sorted(map(tuple, df.select("rule", "series", "since", "state", "at").collect()))
    assert rows(got) == rows(want)
    states = {(r["rule"], r["state"]) for r in want.collect()}
    assert ("PostgresDown", "resolved") in states and ("KubePodCrashLooping", "firing") in states


def test_live_alerts_are_those_of_the_last_evaluation(spark, make_samples, tmp_path):
    pod = {"namespace": "prod", "pod": "p", "reason": "CrashLoopBackOff"}
    samples = make_samples(
        [
            ("pg_up", {}, [1] * 6 + [0] * 4 + [1] * 5 + [0] * 17),
            ("kube_pod_container_status_waiting_reason", pod, [1] * 32),
            ("clock", {}, [0] * 32),
        ]
    )
    path = str(tmp_path / "in")
    write_in_parts(samples, path, spark, ["2026-01-01 00:12:00", "2026-01-01 00:25:00"])
    moves = stream_alert_transitions(stream_samples(spark, path, maxFilesPerTrigger=1), RULES, step_s=60, delay="1 minute")
    drain(moves, str(tmp_path / "out"))
    live = live_alerts(spark, str(tmp_path / "out" / "progress"))
    at = live.agg(F.max("last")).first()[0]
    timeline = alerting.alert_timeline(samples, RULES, step_s=60).where(F.col("t") == at)
    rows = lambda df: sorted(map(tuple, df.select("rule", "series", "since", "state").collect()))
    assert (at - T0).total_seconds() >= 28 * 60
    assert rows(live) == rows(timeline) and {r[3] for r in rows(live)}
    peaks = samples.select("metric", F.col("ts"), "value").schema
    stream = spark.readStream.schema(peaks).parquet(path)
    drain(tumbling(stream, 60, ["metric"]), str(tmp_path / "other"))
    with pytest.raises(ConfigError):
        live_alerts(spark, str(tmp_path / "other" / "progress"))


def test_late_samples_are_dropped(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [
        [("m", {}, datetime(2026, 1, 1, 0, 0, 10), 1.0), ("m", {}, datetime(2026, 1, 1, 0, 10), 1.0)],
        [("m", {}, datetime(2026, 1, 1, 0, 20), 1.0)],
        [("m", {}, datetime(2026, 1, 1, 0, 0, 20), 1.0), ("m", {}, datetime(2026, 1, 1, 0, 30), 1.0)],
        [("m", {}, datetime(2026, 1, 1, 0, 40), 1.0)],
    ]
    for part in rows:
        spark.createDataFrame(part, SAMPLE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = stream_samples(spark, path, maxFilesPerTrigger=1)
    out = drain(tumbling(stream, 30, ["metric"], delay="1 minute"), str(tmp_path / "out"))
    counts = {(r["starts"] - T0).total_seconds(): r["n"] for r in out.collect()}
    assert counts == {0: 1, 600: 1, 1200: 1, 1800: 1}


EVENTS = "run_id string, stage string, kind string, ok boolean, ts timestamp"


def test_stage_runs(spark, tmp_path):
    at = lambda m: datetime(2026, 1, 1, 0, m)
    rows = [
        ("r", "split", "start", None, at(0)),
        ("r", "split", "end", True, at(2)),
        ("r", "train", "start", None, at(3)),
        ("r", "train", "end", False, at(4)),
        ("r", "train", "end", False, at(5)),
        ("r", "evaluate", "start", None, at(5)),
        ("r", "evaluate", "interrupt", None, at(6)),
        ("r", "preprocess", "start", None, at(1)),
        ("z", "clock", "end", True, datetime(2026, 1, 1, 5)),
    ]
    events = spark.createDataFrame(rows, EVENTS)
    want = {
        ("split", 120.0, "success"),
        ("train", 60.0, "failure"),
        ("evaluate", None, "interrupted"),
        ("preprocess", None, "interrupted"),
    }
    rows_of = lambda df: {(r["stage"], r["duration_seconds"], r["outcome"]) for r in df.collect()}
    assert rows_of(stage_runs(events)) == want
    path = str(tmp_path / "in")
    write_in_parts(events, path, spark, ["2026-01-01 00:02:00"])
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(path)
    assert rows_of(drain(stream_stage_runs(stream, timeout_s=1800), str(tmp_path / "out"))) == want
    status = stage_status(stage_runs(events).withColumn("job", F.lit("j")))
    got = {r["stage"]: r["outcome"] for r in status.collect()}
    assert got == {
        "fetch_dataset": "not_run",
        "preprocess": "interrupted",
        "split": "success",
        "train": "failure",
        "evaluate": "interrupted",
    }


def test_gauge_table(spark, tmp_path):
    table = GaugeTable(spark, str(tmp_path / "gauges"))
    push_stage_metrics(table, "j", "split", 1.5, True, 1)
    push_stage_metrics(table, "j", "train", 2.5, False, 2)
    push_stage_metrics(table, "j", "deploy", 9.0, True, 3)
    push_stage_metrics(table, "j", "split", 3.5, True, 4)
    push_stage_metrics(table, "j", "split", 3.5, True, 4)
    rows = {(r["stage"], r["duration_seconds"], r["success"]) for r in table.read().collect()}
    assert rows == {("split", 3.5, 1), ("train", 2.5, 0)}
    table.reset("j", 5)
    assert table.read().isEmpty()
    push_stage_metrics(table, "j", "split", 4.5, True, 6)
    assert [r["duration_seconds"] for r in table.read().collect()] == [4.5]
    # No target: nothing happens.  A broken target: logged, not raised.
    push_stage_metrics(GaugeTable(spark, None), "j", "split", 1.0, True, 1)
    (tmp_path / "file").write_text("x")
    push_stage_metrics(GaugeTable(spark, str(tmp_path / "file" / "x")), "j", "split", 1.0, True, 1)


def test_an_end_that_comes_before_its_start_is_kept(spark, tmp_path):
    from plumbline.streaming.stages import stage_runs, stream_stage_runs

    at = lambda minute: datetime(2026, 1, 1, 0, minute)
    rows = [
        [("r1", "split", "end", True, at(9)), ("r2", "split", "start", True, at(5))],
        [("r1", "split", "start", True, at(3)), ("r2", "split", "start", True, at(4)), ("r2", "split", "end", False, at(8))],
        [("r1", "split", "interrupt", True, at(12)), ("r3", "train", "end", True, at(2))],
        [("clock", "train", "start", True, datetime(2026, 1, 3))],
    ]
    schema = "run_id string, stage string, kind string, ok boolean, ts timestamp"
    path = str(tmp_path / "in")
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = drain(stream_stage_runs(stream, timeout_s=3600, delay="30 minutes"), str(tmp_path / "out"))
    want = stage_runs(spark.read.parquet(path)).where("run_id <> 'clock'")
    key = lambda df: sorted(map(tuple, df.select("run_id", "stage", "started", "duration_seconds", "outcome").collect()))
    assert key(got) == key(want) and len(key(want)) == 2


def test_a_gauge_sink_raises_and_keeps_two_versions(spark, tmp_path):
    import pytest

    table = GaugeTable(spark, str(tmp_path / "gauges"))
    for version in range(1, 6):
        push_stage_metrics(table, "j", "split", float(version), True, version)
    assert sorted(p.name for p in (tmp_path / "gauges").iterdir()) == ["version=4", "version=5"]
    with pytest.raises(Exception):  # noqa: B017
        table.sink()(spark.range(1), 6)
