"""The standing rules on small series: states at given minutes, batch side."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plumbline.operators import alerting
from plumbline.plans.rulepack import standing_rules

T0 = datetime(2026, 1, 1)
RULES = standing_rules(namespace="prod", job="nightly", watched_namespaces="prod|watch")
JOB = {"namespace": "prod", "job_name": "nightly"}
POD = {"namespace": "prod", "pod": "mlflow-7c9f", "container": "mlflow"}
DB = {"namespace": "prod", "pod": "mlflow-postgres-0", "container": "postgres"}
CLAIM = {"persistentvolumeclaim": "data-mlflow-postgres-0"}

CASES = [
    (
        "PipelineJobFailed",
        [("kube_job_failed", {**JOB, "condition": "true"}, [1] * 6)],
        {1: None, 3: ""},
    ),
    (
        "PipelineJobFailed",
        [
            ("kube_job_failed", {**JOB, "condition": "true"}, [0] * 6),
            ("kube_job_status_failed", JOB, [2] * 6),
            ("kube_job_status_succeeded", JOB, [1] * 6),
        ],
        {3: None},
    ),
    (
        "PipelineJobOOMKilled",
        [
            (
                "kube_pod_container_status_terminated_reason",
                {"namespace": "prod", "pod": "nightly-abcde", "reason": "OOMKilled"},
                [1] * 6,
            )
        ],
        {3: ""},
    ),
    (
        "MLflowDown",
        [("probe_success", {"job": "blackbox-mlflow-health"}, [0] * 7 + [1] * 7)],
        {4: None, 5: "", 13: None},
    ),
    (
        "MLflowMemoryHigh",
        [
            ("container_memory_working_set_bytes", POD, [1980000000] * 17),
            ("kube_pod_container_resource_limits", {**POD, "resource": "memory"}, [2147483648] * 17),
        ],
        {14: None, 15: "92%"},
    ),
    ("PostgresDown", [("pg_up", {}, [0] * 7)], {5: ""}),
    (
        "PostgresPVCAlmostFull",
        [
            ("kubelet_volume_stats_used_bytes", CLAIM, [970000000] * 12),
            ("kubelet_volume_stats_capacity_bytes", CLAIM, [1073741824] * 12),
        ],
        {9: None, 10: "90%"},
    ),
    (
        "PostgresMemoryHigh",
        [
            ("container_memory_working_set_bytes", DB, [520000000] * 17),
            ("kube_pod_container_resource_limits", {**DB, "resource": "memory"}, [536870912] * 17),
        ],
        {15: "97%"},
    ),
    (
        "KubePodCrashLooping",
        [
            (
                "kube_pod_container_status_waiting_reason",
                {**POD, "reason": "CrashLoopBackOff"},
                [1] * 17,
            )
        ],
        {15: "mlflow"},
    ),
]


@pytest.mark.parametrize("chunk_s", [None, 120])
@pytest.mark.parametrize("rule,series,expected", CASES)
def test_rule_states(make_samples, rule, series, expected, chunk_s):
    timeline = alerting.alert_timeline(make_samples(series), RULES, step_s=60, chunk_s=chunk_s)
    firing = {
        (r["rule"], r["t"]): r
        for r in alerting.annotate(timeline.where("state = 'firing'"), RULES).collect()
    }
    for minute, text in expected.items():
        row = firing.get((rule, T0 + timedelta(minutes=minute)))
        if text is None:
            assert row is None
        else:
            assert row is not None and text in row["description"]
    assert {name for name, _ in firing} <= {rule}


def test_labels_survive_and_merge(make_samples):
    series = CASES[-1][1]
    timeline = alerting.alert_timeline(make_samples(series), RULES, step_s=60)
    row = alerting.annotate(timeline.where("state = 'firing'"), RULES).first()
    assert row["labels"] == {
        **POD,
        "reason": "CrashLoopBackOff",
        "severity": "warning",
        "layer": "platform",
    }
    assert row["summary"] == "prod/mlflow-7c9f keeps crashing"


def test_transitions_of_an_outage(make_samples):
    samples = make_samples(CASES[3][1])
    end = F.lit("2026-01-01 00:13:00").cast("timestamp")
    timeline = alerting.alert_timeline(samples, RULES, step_s=60, end=end)
    got = {
        (r["state"], (r["at"] - T0).total_seconds() / 60)
        for r in alerting.alert_transitions(timeline, 60, end).collect()
    }
    assert got == {("pending", 0), ("firing", 5), ("resolved", 7)}


def test_gap_starts_over_and_long_runs_cross_chunks(make_samples):
    # 20 minutes down, one good minute, 20 minutes down; the chunk is far shorter.
    samples = make_samples([("pg_up", {}, [0] * 20 + [1] + [0] * 20)])
    end = F.lit("2026-01-01 00:40:00").cast("timestamp")
    for chunk_s in (480, 86_400):
        timeline = alerting.alert_timeline(samples, RULES, step_s=60, end=end, chunk_s=chunk_s)
        since = {(r["since"] - T0).total_seconds() / 60 for r in timeline.collect()}
        assert since == {0, 21}
        states = alerting.alert_transitions(timeline, 60, end).orderBy("at").collect()
        assert [(r["state"], (r["at"] - T0).total_seconds() / 60) for r in states] == [
            ("pending", 0),
            ("firing", 5),
            ("resolved", 20),
            ("pending", 21),
            ("firing", 26),
        ]


def test_absent_metric_is_not_down(make_samples):
    samples = make_samples([("other", {}, [0] * 10)])
    assert alerting.alert_timeline(samples, RULES, step_s=60).isEmpty()
