"""The dashboard panels, as data over the vector operators.

Metric names and the shape of each panel are fixed values; names of one deployment
(namespace, job, tracking server, database) are arguments.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.errors import ConfigError
from plumbline.functions.labels import (
    Selector,
    eq,
    labels_from_key,
    like,
    ne,
    selector,
    series_key,
    unlike,
)
from plumbline.operators.alerting import compare
from plumbline.operators.ranges import (
    increase_grid,
    instant_lookback,
    last_value,
    rate_grid,
    with_series,
)


@dataclass(frozen=True)
class Panel:
    """``kind`` is one of:

    ``series`` the series themselves; ``max|min|sum|avg|count`` an aggregate; ``ratio`` and
    ``difference`` of two aggregates; ``used_share`` = 100 * (1 - left / right) per series;
    ``increase`` and ``rate`` of counters over ``range_s``, summed or averaged.
    """

    title: str
    kind: str
    select: Selector
    by: Sequence[str] = ()
    other: Selector | None = None
    how: tuple[str, str] = ("max", "max")
    range_s: int = 300
    scale: float = 1.0
    keep: tuple[str, float] | None = None
    extra: dict = field(default_factory=dict)


def instant_panels(
    *, namespace: str, job: str, tracker: str = "mlflow", database: str = "mlflow-postgres", prefix: str = ""
) -> list[Panel]:
    """Panels that show the value at one time."""
    here = eq("namespace", namespace)
    this_job = eq("job_name", job)
    ready = selector("kube_node_status_condition", eq("condition", "Ready"), eq("status", "true"))
    tracker_pods = (like("pod", f"{tracker}-.*"), unlike("pod", f"{database}.*"))
    database_pods = (like("pod", f"{database}.*"),)
    real = (ne("container", ""), ne("container", "POD"))
    claim = like("persistentvolumeclaim", f"data-{database}.*")
    memory, limits = "container_memory_working_set_bytes", "kube_pod_container_resource_limits"
    restarts = "kube_pod_container_status_restarts_total"
    sums = ("sum", "sum")

    def used_memory(title, pods):
        return Panel(
            title,
            "ratio",
            selector(memory, here, *pods, *real),
            other=selector(limits, here, *pods, eq("resource", "memory")),
            how=sums,
            scale=100.0,
        )

    return [
        # Cluster.
        Panel("nodes ready", "sum", ready),
        Panel("nodes not ready", "difference", ready, other=ready, how=("count", "sum")),
        Panel(
            "node pressure",
            "sum",
            selector(
                "kube_node_status_condition",
                like("condition", "MemoryPressure|DiskPressure|PIDPressure"),
                eq("status", "true"),
            ),
        ),
        Panel(
            "crash looping",
            "sum",
            selector("kube_pod_container_status_waiting_reason", eq("reason", "CrashLoopBackOff")),
        ),
        Panel("failed jobs", "sum", selector("kube_job_status_failed")),
        Panel(
            "pods not running", "sum", selector("kube_pod_status_phase", like("phase", "Pending|Failed|Unknown"))
        ),
        Panel(
            "unavailable replicas",
            "series",
            selector("kube_deployment_status_replicas_unavailable"),
            keep=(">", 0),
        ),
        Panel("jobs succeeded", "series", selector("kube_job_status_succeeded")),
        Panel("jobs failed", "series", selector("kube_job_status_failed")),
        Panel("jobs active", "series", selector("kube_job_status_active")),
        # Tracking server and database.
        Panel("tracker up", "max", selector("probe_success", eq("job", "blackbox-mlflow-health"))),
        Panel(
            "tracker replicas",
            "max",
            selector("kube_deployment_status_replicas_available", here, eq("deployment", tracker)),
        ),
        Panel(
            "tracker restarts", "increase", selector(restarts, here, *tracker_pods), how=sums, range_s=3600
        ),
        Panel("database up", "max", selector("pg_up")),
        Panel(
            "database replicas",
            "max",
            selector("kube_statefulset_status_replicas_ready", here, eq("statefulset", database)),
        ),
        used_memory("tracker memory", tracker_pods),
        used_memory("database memory", database_pods),
        Panel(
            "database volume",
            "ratio",
            selector("kubelet_volume_stats_used_bytes", claim),
            other=selector("kubelet_volume_stats_capacity_bytes", claim),
            how=sums,
            scale=100.0,
        ),
        Panel("database size", "max", selector("pg_database_size_bytes", eq("datname", "mlflow"))),
        # Batch job.
        Panel("last run succeeded", "max", selector("kube_job_status_succeeded", this_job)),
        Panel("last run failed", "max", selector("kube_job_status_failed", this_job)),
        Panel(
            "last run seconds",
            "difference",
            selector("kube_job_status_completion_time", this_job),
            other=selector("kube_job_status_start_time", this_job),
        ),
        Panel("last run started", "max", selector("kube_job_status_start_time", this_job), scale=1000.0),
        Panel(
            "dataset fetched",
            "max",
            selector(f"{prefix}pipeline_stage_success", eq("stage", "fetch_dataset")),
        ),
        Panel("stage seconds", "series", selector(f"{prefix}pipeline_stage_duration_seconds")),
        Panel("stage success", "series", selector(f"{prefix}pipeline_stage_success")),
        # The metric of the container's current state, as in the alert rule.
        Panel(
            "out of memory",
            "sum",
            selector(
                "kube_pod_container_status_terminated_reason",
                here,
                like("pod", f"{job}.*"),
                eq("reason", "OOMKilled"),
            ),
        ),
        Panel("all stages seconds", "sum", selector(f"{prefix}pipeline_stage_duration_seconds")),
    ]


def trend_panels(
    *, namespace: str, job: str, tracker: str = "mlflow", database: str = "mlflow-postgres", prefix: str = ""
) -> list[Panel]:
    """Panels that show a value over a time grid."""
    here = eq("namespace", namespace)
    this_job = eq("job_name", job)
    real = (ne("container", ""), ne("container", "POD"))
    disk = (eq("mountpoint", "/"), unlike("fstype", "tmpfs|overlay|squashfs"))
    memory = "container_memory_working_set_bytes"
    return [
        Panel(
            "node cpu",
            "rate",
            selector("node_cpu_seconds_total", eq("mode", "idle")),
            by=("instance",),
            how=("avg", "avg"),
            extra={"used_percent": True},
        ),
        Panel(
            "node memory",
            "used_share",
            selector("node_memory_MemAvailable_bytes"),
            other=selector("node_memory_MemTotal_bytes"),
        ),
        Panel(
            "node disk",
            "used_share",
            selector("node_filesystem_avail_bytes", *disk),
            other=selector("node_filesystem_size_bytes", *disk),
        ),
        Panel(
            "restarts",
            "increase",
            selector("kube_pod_container_status_restarts_total"),
            by=("namespace", "pod"),
            how=("sum", "sum"),
            range_s=3600,
        ),
        Panel(
            "replicas available",
            "sum",
            selector("kube_deployment_status_replicas_available"),
            by=("namespace", "deployment"),
        ),
        Panel(
            "replicas wanted", "sum", selector("kube_deployment_spec_replicas"), by=("namespace", "deployment")
        ),
        Panel("pods by phase", "sum", selector("kube_pod_status_phase"), by=("phase",)),
        Panel(
            "probe seconds", "series", selector("probe_duration_seconds", eq("job", "blackbox-mlflow-health"))
        ),
        Panel(
            "tracker memory bytes",
            "sum",
            selector(memory, here, like("pod", f"{tracker}-.*"), unlike("pod", f"{database}.*"), *real),
        ),
        Panel("database memory bytes", "sum", selector(memory, here, like("pod", f"{database}.*"), *real)),
        Panel("database connections", "sum", selector("pg_stat_activity_count")),
        Panel("database connections allowed", "max", selector("pg_settings_max_connections")),
        Panel("stage seconds over time", "series", selector(f"{prefix}pipeline_stage_duration_seconds")),
        Panel("runs succeeded", "max", selector("kube_job_status_succeeded", this_job)),
        Panel("runs failed", "max", selector("kube_job_status_failed", this_job)),
    ]


_COUNTERS = ("increase", "rate")
_PER_SERIES = ("series", "used_share")
_TWO_SIDED = ("ratio", "difference", "used_share")


def _check(panels: Sequence[Panel]) -> None:
    for p in panels:
        if p.kind not in (*_COUNTERS, *_PER_SERIES, *_TWO_SIDED, *_AGGREGATES):
            raise ConfigError(f"{p.title}: unknown panel kind {p.kind!r}")
        if (p.kind in _TWO_SIDED) != (p.other is not None):
            raise ConfigError(f"{p.title}: exactly the two-sided panels need 'other'")


def _tag(vector: DataFrame, panels: Sequence[Panel], at: Sequence[str]) -> DataFrame:
    """``(at, panel, side, group, value)``: one row per series and panel side it belongs to.

    ``group`` is the text of the labels a panel keeps: all of them, or its ``by`` labels.
    """
    cols = vector.columns

    def struct(p: Panel, side: str):
        return F.struct(
            F.lit(p.title).alias("panel"),
            F.lit(side).alias("side"),
            F.lit(p.kind in _PER_SERIES).alias("whole"),
            F.array(*[F.lit(n) for n in p.by]).cast("array<string>").alias("by"),
        )

    tags = [F.when(p.select.condition(cols), struct(p, "left")) for p in panels]
    tags += [F.when(p.other.condition(cols), struct(p, "right")) for p in panels if p.other]
    some = F.map_filter("labels", lambda k, _: F.array_contains(F.col("_t.by"), k))
    group = F.when(F.col("_t.whole"), F.col("series")).otherwise(series_key(some))
    return vector.select(
        *at, "series", "labels", "value", F.explode(F.array_compact(F.array(*tags))).alias("_t")
    ).select(*at, "_t.panel", "_t.side", group.alias("group"), "value")


_AGGREGATES = {
    "max": lambda s: F.col(f"{s}_max"),
    "min": lambda s: F.col(f"{s}_min"),
    "sum": lambda s: F.col(f"{s}_sum"),
    "count": lambda s: F.col(f"{s}_n").cast("double"),
    "avg": lambda s: F.col(f"{s}_sum") / F.col(f"{s}_n"),
}


def _value(p: Panel) -> Column:
    """One panel's value from the summary columns of its sides."""
    if p.kind in _TWO_SIDED:
        how = ("max", "max") if p.kind == "used_share" else p.how
        left, right = _AGGREGATES[how[0]]("left"), _AGGREGATES[how[1]]("right")
        if p.kind == "difference":
            out = left - right
        else:
            out = F.try_divide(left, right)
        if p.kind == "used_share":
            out = 100.0 * (1.0 - out)
        missing = (F.col("left_n") == 0) | (F.col("right_n") == 0)
        return F.when(~missing, out * F.lit(p.scale))
    how = "max" if p.kind == "series" else p.how[0] if p.kind in _COUNTERS else p.kind
    out = _AGGREGATES[how]("left") * F.lit(p.scale)
    if p.extra.get("used_percent"):
        out = 100.0 * (1.0 - out)
    return F.when(compare(out, *p.keep), out) if p.keep else out


def _fold(tagged: DataFrame, panels: Sequence[Panel], at: Sequence[str]) -> DataFrame:
    """All panels in one aggregation with map-side combining; absent panels have no row."""
    sides = []
    for side in ("left", "right"):
        v = F.when(F.col("side") == side, F.col("value"))
        sides += [
            F.max(v).alias(f"{side}_max"),
            F.min(v).alias(f"{side}_min"),
            F.sum(v).alias(f"{side}_sum"),
            F.count(v).alias(f"{side}_n"),
        ]
    value = F.lit(None).cast("double")
    for p in panels:
        value = F.when(F.col("panel") == p.title, _value(p)).otherwise(value)
    return (
        tagged.groupBy("panel", *at, "group")
        .agg(*sides)
        .select("panel", *at, F.col("group").alias("labels"), value.alias("value"))
        .where("value is not null")
    )


def _names(panels: Sequence[Panel]) -> list[str]:
    return sorted({s.metric for p in panels for s in (p.select, p.other) if s is not None})


def _with_labels(vector: DataFrame) -> DataFrame:
    return vector.withColumn("labels", labels_from_key("series"))


def panel_results(
    samples: DataFrame, panels: Sequence[Panel], at: Column, lookback_s: int = 300
) -> DataFrame:
    """``(panel, labels, value)`` of all panels at the time ``at``.

    The newest value of each series within the lookback is found once, with the time bound
    and the metric names pushed to the scan; every panel is then a tag on those values.
    """
    _check(panels)
    gauges = [p for p in panels if p.kind not in _COUNTERS]
    back = lambda s: at - F.make_dt_interval(secs=F.lit(s))
    seen = samples.where((F.col("ts") <= at) & (F.col("ts") >= back(lookback_s)))
    newest = last_value(with_series(seen.where(F.col("metric").isin(*_names(gauges)))))
    tagged = _tag(_with_labels(newest), gauges, ())
    for kind, range_s in sorted({(p.kind, p.range_s) for p in panels if p.kind in _COUNTERS}):
        mine = [p for p in panels if (p.kind, p.range_s) == (kind, range_s)]
        inside = samples.where(
            F.col("metric").isin(*_names(mine)) & (F.col("ts") <= at) & (F.col("ts") >= back(range_s))
        )
        # Shifted so that ``at`` falls on a grid of one step per range.
        moved = F.timestamp_micros(F.unix_micros("ts") - F.unix_micros(at))
        grown = (increase_grid if kind == "increase" else rate_grid)(
            with_series(inside).withColumn("ts", moved), range_s, range_s
        ).where(F.unix_micros("t") == 0)
        tagged = tagged.unionByName(_tag(_with_labels(grown), mine, ()))
    return _fold(tagged, panels, ())


def panel_trends(
    samples: DataFrame,
    panels: Sequence[Panel],
    step_s: int,
    lookback_s: int = 300,
    range_s: int | None = None,
) -> DataFrame:
    """``(panel, t, labels, value)`` of trend panels at every grid time.

    ``range_s`` replaces the panels' own counter ranges where samples are far apart.
    """
    _check(panels)
    gauges = [p for p in panels if p.kind not in _COUNTERS]
    chosen = samples.where(F.col("metric").isin(*_names(gauges)))
    grid = instant_lookback(with_series(chosen), step_s, lookback_s)
    tagged = _tag(_with_labels(grid), gauges, ("t",))
    spans = {(p.kind, range_s or p.range_s) for p in panels if p.kind in _COUNTERS}
    for kind, span in sorted(spans):
        mine = [p for p in panels if p.kind == kind and (range_s or p.range_s) == span]
        made = increase_grid if kind == "increase" else rate_grid
        grown = made(with_series(samples.where(F.col("metric").isin(*_names(mine)))), span, step_s)
        tagged = tagged.unionByName(_tag(_with_labels(grown), mine, ("t",)))
    return _fold(tagged, panels, ("t",))
