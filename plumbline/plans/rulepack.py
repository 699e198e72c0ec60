"""The eight standing alert rules, as data.

Names, metric names, thresholds and durations are fixed values; the namespaces, job,
deployment and claim names they look at are arguments.
"""

from __future__ import annotations

from plumbline.functions.labels import eq, like, ne, selector, unlike
from plumbline.operators.alerting import AlertRule

# Evaluation step, lookback and per-rule thresholds (seconds, percent).
STEP_S = 30
LOOKBACK_S = 300
MEMORY_PERCENT = 90
VOLUME_PERCENT = 85
FOR_JOB_S = 120
FOR_DOWN_S = 300
FOR_VOLUME_S = 600
FOR_PRESSURE_S = 900
# End of fixed values.


def _memory(namespace: str, *pods):
    """Working set of the real containers of some pods, and their memory limits."""
    here = eq("namespace", namespace)
    used = selector(
        "container_memory_working_set_bytes", here, *pods, ne("container", ""), ne("container", "POD")
    )
    limit = selector("kube_pod_container_resource_limits", here, *pods, eq("resource", "memory"))
    return used, limit


def standing_rules(
    *,
    namespace: str,
    job: str,
    watched_namespaces: str,
    tracker: str = "mlflow",
    database: str = "mlflow-postgres",
    probe_job: str = "blackbox-mlflow-health",
) -> list[AlertRule]:
    """The rule pack for one deployment; ``watched_namespaces`` is a pattern."""
    here = eq("namespace", namespace)
    tracker_used, tracker_limit = _memory(
        namespace, like("pod", f"{tracker}-.*"), unlike("pod", f"{database}.*")
    )
    db_used, db_limit = _memory(namespace, like("pod", f"{database}.*"))
    claim = like("persistentvolumeclaim", f"data-{database}.*")

    def tags(severity, layer):
        return {"severity": severity, "layer": layer}

    return [
        AlertRule(
            "PipelineJobFailed",
            "max",
            selector("kube_job_failed", here, eq("job_name", job), eq("condition", "true")),
            "==",
            1,
            FOR_JOB_S,
            labels=tags("critical", "pipeline"),
            summary="The last run of the batch job failed",
        ),
        AlertRule(
            "PipelineJobOOMKilled",
            "max",
            selector(
                "kube_pod_container_status_terminated_reason",
                here,
                like("pod", f"{job}-.*"),
                eq("reason", "OOMKilled"),
            ),
            "==",
            1,
            FOR_JOB_S,
            labels=tags("critical", "pipeline"),
            summary="A pod of the batch job ran out of memory",
        ),
        AlertRule(
            "MLflowDown",
            "max",
            selector("probe_success", eq("job", probe_job)),
            "==",
            0,
            FOR_DOWN_S,
            labels=tags("warning", "mlflow"),
            summary="The tracking server does not answer its health probe",
        ),
        AlertRule(
            "MLflowMemoryHigh",
            "ratio",
            tracker_used,
            ">",
            MEMORY_PERCENT,
            FOR_PRESSURE_S,
            whole=tracker_limit,
            labels=tags("warning", "mlflow"),
            summary="The tracking server is close to its memory limit",
            description="Memory in use is at {value}% of the limit",
        ),
        AlertRule(
            "PostgresDown",
            "max",
            selector("pg_up"),
            "==",
            0,
            FOR_DOWN_S,
            labels=tags("critical", "postgres"),
            summary="The metadata database cannot be reached",
        ),
        AlertRule(
            "PostgresPVCAlmostFull",
            "ratio",
            selector("kubelet_volume_stats_used_bytes", claim),
            ">",
            VOLUME_PERCENT,
            FOR_VOLUME_S,
            whole=selector("kubelet_volume_stats_capacity_bytes", claim),
            labels=tags("critical", "postgres"),
            summary="The database volume is almost full",
            description="The volume is at {value}% of its size",
        ),
        AlertRule(
            "PostgresMemoryHigh",
            "ratio",
            db_used,
            ">",
            MEMORY_PERCENT,
            FOR_PRESSURE_S,
            whole=db_limit,
            labels=tags("warning", "postgres"),
            summary="The database is close to its memory limit",
            description="Memory in use is at {value}% of the limit",
        ),
        AlertRule(
            "KubePodCrashLooping",
            "range_max",
            selector(
                "kube_pod_container_status_waiting_reason",
                like("namespace", watched_namespaces),
                eq("reason", "CrashLoopBackOff"),
            ),
            ">=",
            1,
            FOR_PRESSURE_S,
            range_s=300,
            labels=tags("warning", "platform"),
            summary="{namespace}/{pod} keeps crashing",
            description="Container {container} of {namespace}/{pod} is restarted again and again",
        ),
    ]
