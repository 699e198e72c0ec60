"""Label maps of metric samples: lookup, matching, canonical keys, relabelling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROMOTED = "label_"


def label(name: str, columns: Sequence[str] = ()) -> Column:
    """Value of a label; a missing label equals the empty string.

    Where the frame carries the label as a column of its own (``promote_labels``), that
    column is read, so that filters on it reach the file scan.
    """
    if PROMOTED + name in columns:
        return F.coalesce(F.col(PROMOTED + name), F.lit(""))
    return F.coalesce(F.try_element_at(F.col("labels"), F.lit(name)), F.lit(""))


def promote_labels(samples: DataFrame, names: Sequence[str]) -> DataFrame:
    """Copy often-filtered labels to plain columns ``label_<name>`` before storing."""
    return samples.withColumns(
        {PROMOTED + n: F.nullif(label(n), F.lit("")) for n in names}
    )


@dataclass(frozen=True)
class Matcher:
    """One label condition: ``op`` is ``=``, ``!=``, ``=~`` or ``!~``."""

    name: str
    op: str
    value: str

    def condition(self, columns: Sequence[str] = ()) -> Column:
        if self.op == "=" and self.value and PROMOTED + self.name in columns:
            return F.col(PROMOTED + self.name) == self.value
        found = label(self.name, columns)
        if self.op == "=":
            return found == self.value
        if self.op == "!=":
            return found != self.value
        # Label patterns match the whole value.
        hit = found.rlike(f"^(?:{self.value})$")
        if self.op == "=~":
            return hit
        if self.op == "!~":
            return ~hit
        raise ValueError(f"unknown matcher operator {self.op!r}")


def eq(name: str, value: str) -> Matcher:
    return Matcher(name, "=", value)


def ne(name: str, value: str) -> Matcher:
    return Matcher(name, "!=", value)


def like(name: str, pattern: str) -> Matcher:
    return Matcher(name, "=~", pattern)


def unlike(name: str, pattern: str) -> Matcher:
    return Matcher(name, "!~", pattern)


@dataclass(frozen=True)
class Selector:
    """Series of one metric that satisfy every matcher."""

    metric: str
    matchers: tuple[Matcher, ...] = field(default=())

    def condition(self, columns: Sequence[str] = ()) -> Column:
        hit = F.col("metric") == self.metric
        for m in self.matchers:
            hit = hit & m.condition(columns)
        return hit


def selector(metric: str, *matchers: Matcher) -> Selector:
    return Selector(metric, tuple(matchers))


def select_series(samples: DataFrame, chosen: Selector) -> DataFrame:
    """Samples of the chosen series; the metric name is compared first and pushed down."""
    return samples.where(chosen.condition(samples.columns))


def series_key(labels: Column | str = "labels") -> Column:
    """Canonical text of a label map: sorted by name, empty labels left out.

    Maps cannot be grouped or joined on; this text can, and ``labels_from_key`` turns it
    back, so only the text travels through a shuffle.
    """
    m = F.col(labels) if isinstance(labels, str) else labels
    kept = F.map_filter(m, lambda _, v: v != "")
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(kept))))


def labels_from_key(key: Column | str) -> Column:
    return F.from_json(F.col(key) if isinstance(key, str) else key, "map<string,string>")


def keep_metrics(samples: DataFrame, pattern: str) -> DataFrame:
    """Ingest filter: keep the metrics whose whole name matches ``pattern``."""
    return samples.where(F.col("metric").rlike(f"^(?:{pattern})$"))


def keep_targets(samples: DataFrame, name: str, pattern: str) -> DataFrame:
    """Ingest filter on a label whose whole value matches ``pattern``."""
    return samples.where(like(name, pattern).condition(samples.columns))


def copy_label(samples: DataFrame, source: str, target: str) -> DataFrame:
    """Set ``target`` to the value of ``source``; an empty source changes nothing."""
    value = label(source)
    return samples.withColumn(
        "labels",
        F.when(
            value != "",
            F.map_concat(
                F.map_filter("labels", lambda k, _: k != target),
                F.create_map(F.lit(target), value),
            ),
        ).otherwise(F.col("labels")),
    )


def map_label_names(samples: DataFrame, prefix: str) -> DataFrame:
    """Every label named ``<prefix><rest>`` is also given as ``<rest>``.

    A label that already has the shorter name is replaced, as the copied one is newer.
    """
    skip = len(prefix)
    copied = F.transform_keys(
        F.map_filter("labels", lambda k, _: k.startswith(prefix) & (F.length(k) > skip)),
        lambda k, _: F.substr(k, F.lit(skip + 1)),
    )
    kept = F.map_filter("labels", lambda k, _: ~F.map_contains_key(copied, k))
    return samples.withColumn("labels", F.map_concat(kept, copied))


def attach_target_labels(
    samples: DataFrame, target_labels: Column, honor_labels: bool = True
) -> DataFrame:
    """Merge a target's own labels into the sample labels.

    On a name conflict the sample's value wins when ``honor_labels``; otherwise the
    target's wins and the sample's is kept as ``exported_<name>``.
    """
    mine = F.col("labels")
    if honor_labels:
        rest = F.map_filter(target_labels, lambda k, _: ~F.map_contains_key(mine, k))
        return samples.withColumn("labels", F.map_concat(mine, rest))
    moved = F.transform_keys(
        mine,
        lambda k, _: F.when(F.map_contains_key(target_labels, k), F.concat(F.lit("exported_"), k))
        .otherwise(k),
    )
    return samples.withColumn("labels", F.map_concat(moved, target_labels))
