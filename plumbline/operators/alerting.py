"""Alert rules over metric samples: evaluation, pending and firing, transitions.

A rule is data.  All rules are evaluated together: samples are scanned once, each is
tagged with the rule terms it satisfies, and one lookback and one aggregation serve every
rule.  A rule is pending from the first grid time its condition holds, and firing once it
has held at every grid time for its duration; one grid time without it starts over.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.errors import ConfigError
from plumbline.functions.labels import Selector, labels_from_key, series_key
from plumbline.functions.scalars import template
from plumbline.operators.chunks import CHUNK, GHOST, MICROS, carry_last, chunk_width, with_chunks
from plumbline.operators.ranges import grid_time, grid_window, instant_lookback
from plumbline.session import stored

NO_LABELS = "{}"
_COMPARE = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def compare(value: Column | str, op: str, bound: float) -> Column:
    """A comparison used as a filter: the value itself is kept by the caller."""
    if op not in _COMPARE:
        raise ConfigError(f"comparison must be one of {sorted(_COMPARE)}, got {op!r}")
    return _COMPARE[op](F.col(value) if isinstance(value, str) else value, F.lit(float(bound)))


@dataclass(frozen=True)
class AlertRule:
    """``kind`` says what is compared with ``bound``.

    ``max``: the largest instant value over the selected series; ``ratio``: 100 times the
    sum of ``select`` over the sum of ``whole``; ``range_max``: per series, the largest
    sample of the last ``range_s`` seconds, with the series' labels kept.
    """

    name: str
    kind: str
    select: Selector
    op: str
    bound: float
    for_s: int
    whole: Selector | None = None
    range_s: int = 300
    labels: dict = field(default_factory=dict)
    summary: str = ""
    description: str = ""

    def __post_init__(self):
        if self.kind not in ("max", "ratio", "range_max"):
            raise ConfigError(f"{self.name}: unknown rule kind {self.kind!r}")
        if (self.kind == "ratio") != (self.whole is not None):
            raise ConfigError(f"{self.name}: a ratio, and only a ratio, needs 'whole'")

    def terms(self) -> list[tuple[str, Selector]]:
        return [("part", self.select)] + ([("whole", self.whole)] if self.whole else [])


def tag_terms(samples: DataFrame, rules: Sequence[AlertRule], *more: str) -> DataFrame:
    """``(rule, side, series, ts, value)``: one row per sample and rule term it satisfies.

    ``more`` names further columns to keep.

    The metric names of all rules are filtered first, which reaches the file scan.
    """
    cols = samples.columns
    terms = [(r.name, side, sel) for r in rules for side, sel in r.terms()]
    tags = F.array(
        *[
            F.when(sel.condition(cols), F.struct(F.lit(name).alias("rule"), F.lit(side).alias("side")))
            for name, side, sel in terms
        ]
    )
    return (
        samples.where(F.col("metric").isin(*{sel.metric for _, _, sel in terms}))
        .select(
            F.explode(F.array_compact(tags)).alias("_t"),
            series_key().alias("series"),
            "ts",
            "value",
            *more,
        )
        .select("_t.rule", "_t.side", "series", "ts", "value", *more)
    )


def fold_terms(instant: DataFrame, rules: Sequence[AlertRule], at: Sequence[Column]) -> DataFrame:
    """Values of the ``max`` and ``ratio`` rules from instant values of their terms."""
    part = F.when(F.col("side") == "part", F.col("value"))
    whole = F.when(F.col("side") == "whole", F.col("value"))
    ratios = [r.name for r in rules if r.kind == "ratio"]
    is_ratio = F.col("rule").isin(*ratios) if ratios else F.lit(False)
    return (
        instant.groupBy("rule", *at)
        .agg(F.max(part).alias("_max"), F.sum(part).alias("_part"), F.sum(whole).alias("_whole"))
        .withColumn(
            "value",
            F.when(is_ratio, F.try_divide(F.lit(100.0) * F.col("_part"), F.col("_whole"))).otherwise(
                F.col("_max")
            ),
        )
        .where("value is not null")
        .withColumn("series", F.lit(NO_LABELS))
        .drop("_max", "_part", "_whole")
    )


def condition_holds(values: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """Keep the values that meet their rule's comparison."""
    holds = reduce(
        lambda a, b: a | b,
        [(F.col("rule") == r.name) & compare("value", r.op, r.bound) for r in rules],
    )
    return values.where(holds)


def evaluate_rules(
    samples: DataFrame,
    rules: Sequence[AlertRule],
    *,
    step_s: int,
    lookback_s: int = 300,
    end: Column | None = None,
) -> DataFrame:
    """``(rule, series, t, value)`` at every grid time where a rule's condition holds."""
    spot = [r for r in rules if r.kind != "range_max"]
    spans = [r for r in rules if r.kind == "range_max"]
    out = []
    if spot:
        instant = instant_lookback(
            tag_terms(samples, spot), step_s, lookback_s, keys=("rule", "side", "series"), end=end
        )
        out.append(fold_terms(instant, spot, [F.col("t")]).select("rule", "series", "t", "value"))
    for range_s in sorted({r.range_s for r in spans}):
        mine = [r for r in spans if r.range_s == range_s]
        peak = (
            tag_terms(samples, mine)
            .groupBy("rule", "series", grid_window(range_s, step_s).alias("_w"))
            .agg(F.max("value").alias("value"))
            .select("rule", "series", grid_time().alias("t"), "value")
        )
        out.append(peak if end is None else peak.where(F.col("t") <= end))
    return condition_holds(reduce(DataFrame.unionByName, out), rules)


def active_since(
    held: DataFrame,
    step_s: int,
    *,
    keys: Sequence[str] = ("rule", "series"),
    chunk_s: int | None = None,
) -> DataFrame:
    """``since`` = start of the unbroken run of grid times each row belongs to.

    Runs are found inside time chunks, with the last step before a chunk copied into it;
    a run that began in an earlier chunk gets its start from the chunk summary.
    """
    step = step_s * MICROS
    width = chunk_width(step, (chunk_s or 86_400) * MICROS)
    w = Window.partitionBy(*keys, CHUNK).orderBy("_us")
    gap = F.col("_us") - F.lag("_us").over(w)
    named = held.withColumns({k: F.coalesce(F.col(k), F.lit("")) for k in keys})
    starts = (
        with_chunks(named.withColumn("_us", F.unix_micros("t")), "_us", width, ahead_us=step)
        .withColumn("_start", F.when(gap.isNull() | (gap > step), F.col("_us")))
        .where(~F.col(GHOST))
        .drop(GHOST)
    )
    return (
        carry_last(starts, keys, CHUNK, "_us", F.col("_start"), "_since")
        .withColumn("since", F.timestamp_micros("_since"))
        .drop("_us", "_start", "_since", CHUNK)
    )


def _durations(rules: Sequence[AlertRule]) -> Column:
    out = F.lit(None).cast("bigint")
    for r in rules:
        out = F.when(F.col("rule") == r.name, F.lit(r.for_s * MICROS)).otherwise(out)
    return out


def alert_timeline(
    samples: DataFrame,
    rules: Sequence[AlertRule],
    *,
    step_s: int,
    lookback_s: int = 300,
    end: Column | None = None,
    chunk_s: int | None = None,
) -> DataFrame:
    """``(rule, series, t, value, since, state)``; inactive times have no row.

    The times at which a condition holds, few next to the samples, are stored once, as the
    search for the starts reads them twice.
    """
    held = stored(
        evaluate_rules(samples, rules, step_s=step_s, lookback_s=lookback_s, end=end), "held"
    )
    lasted = F.unix_micros("t") - F.unix_micros("since")
    return active_since(held, step_s, chunk_s=chunk_s).withColumn(
        "state", F.when(lasted >= _durations(rules), "firing").otherwise("pending")
    )


def alert_transitions(timeline: DataFrame, step_s: int, end: Column | None = None) -> DataFrame:
    """``(rule, series, since, state, at)``: when each run became pending, firing, resolved.

    A run that fired is resolved at the first grid time after it; one that never fired
    just goes ``inactive``.  Transitions after ``end`` have not happened yet.  Each run is
    one group with map-side combining, so no window over a whole alert is needed.
    """
    runs = timeline.groupBy("rule", "series", "since").agg(
        F.min(F.when(F.col("state") == "firing", F.col("t"))).alias("fired"), F.max("t").alias("last")
    )
    after = F.timestamp_micros(F.unix_micros("last") + F.lit(step_s * MICROS))
    pending = F.when(
        F.col("fired").isNull() | (F.col("fired") > F.col("since")),
        F.struct(F.lit("pending").alias("state"), F.col("since").alias("at")),
    )
    firing = F.when(
        F.col("fired").isNotNull(), F.struct(F.lit("firing").alias("state"), F.col("fired").alias("at"))
    )
    over = F.struct(
        F.when(F.col("fired").isNotNull(), "resolved").otherwise("inactive").alias("state"),
        after.alias("at"),
    )
    closing = over if end is None else F.when(after <= end, over)
    return runs.select(
        "rule", "series", "since", F.inline(F.array_compact(F.array(pending, firing, closing)))
    )


def firing_at(timeline: DataFrame, when: Column) -> DataFrame:
    """Alerts that fire at one grid time."""
    return timeline.where((F.col("t") == when) & (F.col("state") == "firing"))


def _overlay(labels: Column, fixed: dict) -> Column:
    """Label map with some labels set."""
    top = F.create_map(*[F.lit(x) for kv in fixed.items() for x in kv])
    return F.map_concat(F.map_filter(labels, lambda k, _: ~k.isin(*fixed)), top)


def annotate(timeline: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """Add the rule's labels merged over the series' labels, and the rendered texts."""
    own = labels_from_key("series")
    merged, summary, description = own, F.lit(""), F.lit("")
    for r in rules:
        mine = F.col("rule") == r.name
        if r.labels:
            merged = F.when(mine, _overlay(own, r.labels)).otherwise(merged)
        summary = F.when(mine, template(r.summary, own, F.col("value"))).otherwise(summary)
        description = F.when(mine, template(r.description, own, F.col("value"))).otherwise(description)
    return timeline.withColumns({"labels": merged, "summary": summary, "description": description})
