"""Queries over metric samples: selectors, vectors, ranges, alerts.

The samples are the events: the type is the metric, the user its label.  There are about
14 events an hour over all series, so steps and ranges are hours, not seconds.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import display, labels
from plumbline.functions.labels import eq, like, ne, select_series, selector, unlike
from plumbline.operators import alerting, ranges, vectors
from plumbline.operators.alerting import AlertRule
from plumbline.plans.panels import instant_panels, panel_results, panel_trends, trend_panels
from plumbline.plans.registry import query
from plumbline.plans.rulepack import standing_rules
from plumbline.plans.tables import event_samples, table
from plumbline.session import shared_dir
from plumbline.sources.exposition import read_sample_text, write_sample_text
from plumbline.sources.samples import read_samples, store_chunked, write_samples
from plumbline.streaming.gauges import gauge_samples, newest_gauges
from plumbline.streaming.stages import stage_runs, stage_status

HOUR = 3600
LOOKBACK = 6 * HOUR
END = "2024-01-31 00:00:00"
NTZ = "timestamp_ntz"


def _samples(spark, sf):
    return event_samples(table(spark, sf, "events"))


def _series(spark, sf):
    return ranges.with_series(_samples(spark, sf))


def _user(df, *rest):
    """The user label back as a column, and times without a zone."""
    times = [c for c, kind in df.dtypes if kind == "timestamp"]
    out = df.withColumn("user_id", F.get_json_object("series", "$.user_id"))
    return out.withColumns({c: F.col(c).cast(NTZ) for c in times}).select("user_id", *rest)


_GRID = """g AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS t FROM (SELECT
    date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) + INTERVAL 7 HOUR AS hi FROM events))"""
_INSTANT = f"""{_GRID}, inst AS (SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user_id, t,
    arg_max(value, ts) AS value, max(ts) AS sample_ts FROM events
    JOIN g ON ts <= t AND ts >= t - INTERVAL 6 HOUR GROUP BY ALL)"""

# ---------------------------------------------------------------- selection and labels


@query("""SELECT count(*) FILTER (event_type = 'click' AND CAST(user_id AS VARCHAR) = '7') AS equal,
    count(*) FILTER (event_type = 'click' AND CAST(user_id AS VARCHAR) <> '7') AS not_equal,
    count(*) FILTER (event_type = 'click' AND regexp_full_match(CAST(user_id AS VARCHAR), '1|2.')) AS matches,
    count(*) FILTER (event_type = 'click' AND NOT regexp_full_match(CAST(user_id AS VARCHAR), '1|2.')) AS no_match,
    count(*) FILTER (event_type = 'click') AS absent_is_empty,
    CAST(0 AS BIGINT) AS absent_not_empty FROM events""")
def label_matchers(spark, sf):
    samples = _samples(spark, sf)
    tests = {
        "equal": eq("user_id", "7"),
        "not_equal": ne("user_id", "7"),
        "matches": like("user_id", "1|2."),
        "no_match": unlike("user_id", "1|2."),
        "absent_is_empty": eq("container", ""),
        "absent_not_empty": ne("container", ""),
    }
    return select_series(samples, selector("click")).agg(
        *[F.count(F.when(m.condition(), 1)).alias(name) for name, m in tests.items()]
    )


@query("""SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user_id, ts, value FROM events
    WHERE event_type IN ('click', 'purchase') AND value > 50 AND regexp_full_match(CAST(user_id AS VARCHAR), '[1-5].*')""")
def stored_sample_scan(spark, sf):
    """Samples stored by metric and day with the label as a column; both filters are pushed."""
    path = shared_dir(spark, "samples")
    write_samples(_samples(spark, sf), path, promoted=["user_id"])
    kept = labels.keep_metrics(read_samples(spark, path), "click|purchase")
    kept = labels.keep_targets(kept, "user_id", "[1-5].*").where(alerting.compare("value", ">", 50))
    return kept.select(
        "metric", F.col("label_user_id").alias("user_id"), F.col("ts").cast(NTZ).alias("ts"), "value"
    )


# The note holds every character that the text form escapes.
_TEXT_SQL = """SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user_id, event_type || chr(92) || chr(34) || chr(10) || 'n' AS note,
      date_trunc('milliseconds', ts) AS ts, value, CAST(NULL AS VARCHAR) AS bad FROM events
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, event_type || '{user_id="' || user_id || '" 1' FROM events WHERE event_id % 20 = 0"""


def sample_text(spark, sf, path):
    """The events as lines of text, among them some that are cut off."""
    note = F.concat("event_type", F.lit('\\"\nn'))
    labels = F.create_map(F.lit("user_id"), F.col("user_id").cast("string"), F.lit("note"), note)
    events = table(spark, sf, "events")
    write_sample_text(events.select(F.col("event_type").alias("metric"), labels.alias("labels"), F.col("ts").cast("timestamp").alias("ts"), "value"), path)
    cut = F.concat("event_type", F.lit('{user_id="'), F.col("user_id").cast("string"), F.lit('" 1'))
    events.where("event_id % 20 = 0").select(cut.alias("value")).write.mode("append").text(path)


def text_columns(parsed):
    label = lambda name: F.col("labels")[name].alias(name)
    return _no_zone(parsed.select("metric", label("user_id"), label("note"), "ts", "value", "bad"))


@query(_TEXT_SQL)
def sample_text_round_trip(spark, sf):
    """The events written as lines of text and parsed again; broken lines are kept apart."""
    path = shared_dir(spark, "text")
    sample_text(spark, sf, path)
    return text_columns(read_sample_text(spark, path))


@query("""SELECT event_id, '{"exported_job":"' || event_type || '","instance":"' || user_id || '","job":"events","node_zone":"z",'
    || '"user_id":"' || user_id || '","zone":"z"}' AS replaced, '{"instance":"' || user_id || '","job":"' || event_type ||
    '","node_zone":"z","user_id":"' || user_id || '","zone":"z"}' AS honored FROM events""")
def relabelled(spark, sf):
    """Copy a label, map a name prefix, and merge target labels with either precedence."""
    events = table(spark, sf, "events").select(
        "event_id",
        F.create_map(
            F.lit("user_id"),
            F.col("user_id").cast("string"),
            F.lit("job"),
            F.col("event_type"),
            F.lit("node_zone"),
            F.lit("z"),
        ).alias("labels"),
    )
    base = labels.map_label_names(labels.copy_label(events, "user_id", "instance"), "node_")
    target = F.create_map(F.lit("job"), F.lit("events"))
    kept = labels.attach_target_labels(base, target).withColumn("honored", labels.series_key())
    again = kept.withColumn("labels", F.col("labels"))
    return (
        labels.attach_target_labels(again, target, honor_labels=False)
        .withColumn("replaced", labels.series_key())
        .select("event_id", "replaced", "honored")
    )


# ---------------------------------------------------------------- vectors


@query("""SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user_id, arg_max(value, ts) AS value,
    max(ts) AS ts FROM events GROUP BY ALL""", headline=True)
def last_value_per_series(spark, sf):
    return _user(ranges.last_value(_series(spark, sf)), "metric", "value", "ts")


@query("""WITH a AS (SELECT event_type AS metric, max(value) AS largest, sum(CAST(value AS DECIMAL(18,2))) AS total,
    count(*) AS n FROM events WHERE event_type IN ('error', 'view') GROUP BY event_type)
    SELECT metric, 'max' AS how, largest AS value FROM a UNION ALL
    SELECT metric, 'sum', CAST(total AS DOUBLE) FROM a UNION ALL SELECT metric, 'count', CAST(n AS DOUBLE) FROM a""")
def global_aggregates(spark, sf):
    """Two metrics that exist and one that does not: the absent one has no rows."""
    samples = _samples(spark, sf)
    out = None
    for metric in ("error", "view", "absent"):
        chosen = select_series(samples, selector(metric))
        for how in ("max", "sum", "count"):
            one = vectors.aggregate(chosen, how).select(
                F.lit(metric).alias("metric"),
                F.lit(how).alias("how"),
                F.round(F.col("value").cast("double"), 2).alias("value"),
            )
            out = one if out is None else out.unionByName(one)
    return out


@query("SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events WHERE event_type = 'purchase' GROUP BY user_id")
def sum_by(spark, sf):
    chosen = select_series(_samples(spark, sf), selector("purchase"))
    return vectors.aggregate(chosen, "sum", by=["user_id"]).withColumn("value", F.round("value", 2))


@query("SELECT CAST(user_id AS VARCHAR) AS user_id, round(avg(value), 6) AS value FROM events WHERE event_type = 'view' GROUP BY user_id")
def avg_by(spark, sf):
    chosen = select_series(_samples(spark, sf), selector("view"))
    return vectors.aggregate(chosen, "avg", by=["user_id"]).withColumn("value", F.round("value", 6))


@query("SELECT CAST(user_id AS VARCHAR) AS user_id, min(value) AS value FROM events WHERE event_type = 'click' GROUP BY user_id")
def min_by_job(spark, sf):
    chosen = select_series(_samples(spark, sf), selector("click"))
    return vectors.aggregate(chosen, "min", by=["user_id"])


@query("""SELECT CAST(ts AS DATE) AS day, round(100 * sum(value) FILTER (event_type = 'error')
    / sum(value) FILTER (event_type = 'view'), 6) AS value FROM events WHERE event_type IN ('error', 'view')
    GROUP BY day HAVING count(*) FILTER (event_type = 'error') > 0 AND count(*) FILTER (event_type = 'view') > 0""")
def ratio_of_sums(spark, sf):
    daily = _samples(spark, sf).withColumn("day", F.to_date("ts"))
    out = vectors.ratio_of_sums(daily, selector("error"), selector("view"), at=["day"])
    return out.withColumn("value", F.round("value", 6))


@query("""SELECT CAST(user_id AS VARCHAR) AS user_id, max(value) FILTER (event_type = 'purchase')
    - max(value) FILTER (event_type = 'click') AS value FROM events GROUP BY user_id
    HAVING count(*) FILTER (event_type = 'purchase') > 0 AND count(*) FILTER (event_type = 'click') > 0""")
def difference_of_aggs(spark, sf):
    return vectors.combine(
        _samples(spark, sf),
        ("max", selector("purchase")),
        ("max", selector("click")),
        "difference",
        by=["user_id"],
    )


@query("""WITH d AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS v
    FROM events GROUP BY ALL)
    SELECT a.day, CAST(a.user_id AS VARCHAR) AS user_id, round(100 * CAST(a.v AS DOUBLE) / CAST(b.v AS DOUBLE), 6) AS value
    FROM d a JOIN d b ON a.day = b.day AND a.user_id = b.user_id AND a.event_type = 'error' AND b.event_type = 'view'""", headline=True)
def vector_match(spark, sf):
    daily = (
        _series(spark, sf)
        .where(F.col("metric").isin("error", "view"))
        .groupBy("metric", "series", F.to_date("ts").alias("day"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"))
    )
    both = vectors.match_series(daily, "error", "view", at=["day"])
    value = F.round(vectors.float_ratio(100 * F.col("left_value"), F.col("right_value")), 6)
    return _user(both.withColumn("value", value), "day", "value")


@query("""WITH l AS (SELECT event_type, user_id, arg_max(value, ts) AS v FROM events GROUP BY ALL)
    SELECT CAST(user_id AS VARCHAR) AS user_id, max(v) FILTER (event_type = 'click') AS clicked,
    max(v) FILTER (event_type = 'view') AS viewed, max(v) FILTER (event_type = 'purchase') AS bought
    FROM l WHERE event_type IN ('click', 'view', 'purchase') GROUP BY user_id""")
def wide_status(spark, sf):
    newest = ranges.last_value(_series(spark, sf)).withColumn("labels", labels.labels_from_key("series"))
    return vectors.wide_status(
        newest, {"click": "clicked", "view": "viewed", "purchase": "bought"}, ["user_id"]
    )


_DAILY_TOTAL = """SELECT event_type AS stage, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY event_type"""


def _totals(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("stage")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    )


@query(_DAILY_TOTAL + " ORDER BY total DESC, stage LIMIT 1")
def top_stage(spark, sf):
    return vectors.top_k(_totals(spark, sf), "total", 1, ["stage"])


@query(f"WITH s AS ({_DAILY_TOTAL}) SELECT stage, total, round(total / (SELECT sum(total) FROM s), 9) AS share FROM s")
def share_of_total(spark, sf):
    return vectors.share_of_total(_totals(spark, sf), "total").withColumn("share", F.round("share", 9))


@query(f"WITH s AS ({_DAILY_TOTAL}) SELECT stage AS name, total FROM s WHERE total = (SELECT max(total) FROM s)")
def dominant_stage(spark, sf):
    top = vectors.dominant(_totals(spark, sf).withColumn("extra", F.lit(1)), "total")
    return vectors.organise(top, exclude=["extra", "not there"], rename={"stage": "name"})


# ---------------------------------------------------------------- lookback and ranges


@query(f"WITH {_INSTANT} SELECT metric, user_id, t, value, sample_ts FROM inst", headline=True)
def instant_lookback_grid(spark, sf):
    grid = ranges.instant_lookback(_series(spark, sf), HOUR, LOOKBACK)
    return _user(grid, "metric", "t", "value", "sample_ts")


@query(f"""WITH {_INSTANT} SELECT metric, t, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value, count(*) AS n_series
    FROM inst GROUP BY metric, t""")
def trend(spark, sf):
    """A range query: the sum over all series at every step."""
    grid = ranges.instant_lookback(_series(spark, sf), HOUR, LOOKBACK)
    out = grid.groupBy("metric", "t").agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"),
        F.count(F.lit(1)).alias("n_series"),
    )
    return out.withColumn("t", F.col("t").cast(NTZ))


@query("""SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user_id, ts, value, max(value) OVER (PARTITION BY
    event_type, user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS over FROM events""", headline=True)
def max_over_time(spark, sf):
    return _user(ranges.over_time(_series(spark, sf), LOOKBACK, "max"), "metric", "ts", "value", "over")


def _stored_series(spark, sf):
    """The series as a bucketed table, cut into chunks for ranges of three days."""
    name = f"samples_{uuid.uuid4().hex}"
    return store_chunked(_samples(spark, sf), name, shared_dir(spark, "chunked"), reach_s=72 * HOUR)


@query("""SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user_id, ts, value, max(value) OVER (PARTITION BY
    event_type, user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS over FROM events""")
def stored_max_over_time(spark, sf):
    """The largest value of a range, from stored chunks where they lie."""
    return _user(ranges.over_time(_stored_series(spark, sf), LOOKBACK, "max"), "metric", "ts", "value", "over")


@query("""WITH m AS (SELECT event_type AS metric, user_id, ts, value, CASE WHEN value <> lag(value) OVER w THEN 1 ELSE 0 END AS moved,
      CASE WHEN value < lag(value) OVER w THEN value ELSE value - lag(value) OVER w END AS grown
      FROM events WINDOW w AS (PARTITION BY event_type, user_id ORDER BY ts)),
    f AS (SELECT metric, CAST(user_id AS VARCHAR) AS user_id, ts, count(*) OVER r AS n, sum(grown) OVER r - coalesce(first_value(grown) OVER r, 0) AS raw,
      CAST(sum(moved) OVER r - first_value(moved) OVER r AS BIGINT) AS changes FROM m
      WINDOW r AS (PARTITION BY metric, user_id ORDER BY ts RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW))
    SELECT metric, user_id, ts, round(raw, 6) AS grown, changes FROM f WHERE n >= 2""")
def stored_growth_and_changes(spark, sf):
    """Growth with resets and number of changes over three days, both from one stored table."""
    chunks = _stored_series(spark, sf)
    grown = ranges.increase(chunks, 72 * HOUR, extrapolate=False).withColumnRenamed("value", "grown")
    moved = ranges.changes(chunks, 72 * HOUR)
    both = grown.join(moved, ["metric", "series", "ts"]).withColumn("grown", F.round("grown", 6))
    return _user(both, "metric", "ts", "grown", "changes")


@query(f"""WITH {_GRID} SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user_id, t, max(value) AS value
    FROM events JOIN g ON ts <= t AND ts >= t - INTERVAL 6 HOUR GROUP BY ALL""")
def max_over_time_grid(spark, sf):
    return _user(ranges.over_time_grid(_series(spark, sf), LOOKBACK, HOUR), "metric", "t", "value")


_COUNTER = """c AS (SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user_id, ts, epoch_us(ts) AS us, CAST(row_number() OVER
    (PARTITION BY event_type, user_id, CAST(ts AS DATE) ORDER BY ts) AS DOUBLE) AS v FROM events),
    d AS (SELECT *, CASE WHEN v < lag(v) OVER w THEN v ELSE v - lag(v) OVER w END AS grown FROM c
      WINDOW w AS (PARTITION BY metric, user_id ORDER BY ts))"""
_COUNTER_RANGES = f"""{_COUNTER}, f AS (SELECT metric, user_id, ts, count(*) OVER r AS n,
      sum(grown) OVER r - coalesce(first_value(grown) OVER r, 0) AS raw, first_value(v) OVER r AS v0,
      first_value(us) OVER r AS t0, us AS t1, us AS te FROM d WINDOW r AS (PARTITION BY metric, user_id ORDER BY ts
      RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW))"""
_STRETCH = """, x AS (SELECT *, CAST(t1 - t0 AS DOUBLE) AS span, CAST(t1 - t0 AS DOUBLE) / (n - 1) AS gap,
      CAST(t0 - (te - 259200000000) AS DOUBLE) AS ds, CAST(te - t1 AS DOUBLE) AS de FROM f WHERE n >= 2 AND t1 > t0),
    y AS (SELECT *, CASE WHEN ds < gap * 1.1 THEN ds ELSE gap / 2 END AS s0,
      CASE WHEN de < gap * 1.1 THEN de ELSE gap / 2 END AS e0 FROM x),
    z AS (SELECT *, CASE WHEN raw > 0 AND v0 >= 0 THEN least(s0, span * (v0 / raw)) ELSE s0 END AS s1 FROM y)"""


def _counter(spark, sf):
    """A running count per series that starts over every day."""
    day = Window.partitionBy("metric", "series", F.to_date("ts")).orderBy("ts")
    return _series(spark, sf).withColumn("value", F.row_number().over(day).cast("double"))


@query(f"WITH {_COUNTER_RANGES} SELECT metric, user_id, ts, raw AS value FROM f WHERE n >= 2")
def counter_increase(spark, sf):
    grown = ranges.increase(_counter(spark, sf), 72 * HOUR, extrapolate=False)
    return _user(grown, "metric", "ts", "value")


@query(f"""WITH {_COUNTER_RANGES} {_STRETCH} SELECT metric, user_id, ts,
    round(raw * ((span + s1 + e0) / span) / 259200.0 * 1e6, 6) AS per_second_e6 FROM z""", headline=True)
def counter_rate(spark, sf):
    per_second = ranges.rate(_counter(spark, sf), 72 * HOUR)
    out = per_second.withColumn("per_second_e6", F.round(F.col("value") * 1e6, 6))
    return _user(out, "metric", "ts", "per_second_e6")


@query(f"""WITH {_COUNTER}, k AS (SELECT unnest(generate_series(lo, hi, INTERVAL 12 HOUR)) AS t FROM (SELECT
      date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) + INTERVAL 5 DAY AS hi FROM events)),
    f AS (SELECT metric, user_id, t, count(*) AS n, sum(grown) - coalesce(arg_min_null(grown, ts), 0) AS raw, arg_min(v, ts) AS v0,
      min(us) AS t0, max(us) AS t1, epoch_us(t) AS te FROM d JOIN k ON ts <= t AND ts >= t - INTERVAL 3 DAY GROUP BY ALL)
    {_STRETCH} SELECT metric, user_id, t, round(raw * ((span + s1 + e0) / span), 6) AS value FROM z""")
def counter_increase_grid(spark, sf):
    grown = ranges.increase_grid(_counter(spark, sf), 72 * HOUR, 12 * HOUR)
    return _user(grown.withColumn("value", F.round("value", 6)), "metric", "t", "value")


@query(f"""WITH {_COUNTER}, m AS (SELECT metric, user_id, ts, CASE WHEN v <> lag(v) OVER w THEN 1 ELSE 0 END AS moved
      FROM c WINDOW w AS (PARTITION BY metric, user_id ORDER BY ts))
    SELECT metric, user_id, ts, CAST(sum(moved) OVER r - first_value(moved) OVER r AS BIGINT) AS changes FROM m
    WINDOW r AS (PARTITION BY metric, user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)""")
def change_count(spark, sf):
    return _user(ranges.changes(_counter(spark, sf), 7 * 24 * HOUR), "metric", "ts", "changes")


@query("SELECT event_type AS metric, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY event_type")
def retained_samples(spark, sf):
    kept = ranges.retained(_samples(spark, sf), 7, F.lit(END).cast("timestamp"))
    return kept.groupBy("metric").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- alerts

RULES = [
    AlertRule("ErrorPeak", "max", selector("error"), ">", 150, 2 * HOUR, labels={"severity": "critical"}, summary="error peak {value}"),
    AlertRule("ErrorShare", "ratio", selector("error"), ">", 95, 3 * HOUR, whole=selector("view"), summary="errors at {value}%"),
    AlertRule("LargePurchase", "range_max", selector("purchase"), ">=", 60, 4 * HOUR, range_s=LOOKBACK, summary="user {user_id}"),
]

_TIMELINE = f"""{_INSTANT}, vals AS (
      SELECT 'ErrorPeak' AS rule, '{{}}' AS series, t, max(value) AS value FROM inst WHERE metric = 'error' GROUP BY t
      UNION ALL SELECT 'ErrorShare', '{{}}', t, 100 * sum(value) FILTER (metric = 'error') / sum(value) FILTER (metric = 'view')
        FROM inst GROUP BY t
      UNION ALL SELECT 'LargePurchase', '{{"user_id":"' || user_id || '"}}', t, max(value) FROM events
        JOIN g ON ts <= t AND ts >= t - INTERVAL 6 HOUR WHERE event_type = 'purchase' GROUP BY user_id, t),
    held AS (SELECT * FROM vals WHERE (rule = 'ErrorPeak' AND value > 150)
      OR (rule = 'ErrorShare' AND value > 95) OR (rule = 'LargePurchase' AND value >= 60)),
    starts AS (SELECT *, CASE WHEN t - lag(t) OVER w <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS s FROM held
      WINDOW w AS (PARTITION BY rule, series ORDER BY t)),
    islands AS (SELECT *, sum(s) OVER (PARTITION BY rule, series ORDER BY t) AS island FROM starts),
    since AS (SELECT *, min(t) OVER (PARTITION BY rule, series, island) AS since FROM islands),
    timeline AS (SELECT rule, series, t, value, since, CASE WHEN t - since >= CASE rule WHEN 'ErrorPeak' THEN INTERVAL 2 HOUR
      WHEN 'ErrorShare' THEN INTERVAL 3 HOUR ELSE INTERVAL 4 HOUR END THEN 'firing' ELSE 'pending' END AS state FROM since)"""
_TRANSITIONS = f"""{_TIMELINE}, runs AS (SELECT rule, series, since, min(t) FILTER (state = 'firing') AS fired,
      max(t) + INTERVAL 1 HOUR AS after FROM timeline GROUP BY rule, series, since),
    moves AS (SELECT rule, series, since, 'pending' AS state, since AS at_time FROM runs
      UNION ALL SELECT rule, series, since, 'firing', fired FROM runs WHERE fired IS NOT NULL
      UNION ALL SELECT rule, series, since, CASE WHEN fired IS NULL THEN 'inactive' ELSE 'resolved' END, after FROM runs)"""


def _timeline(spark, sf):
    return alerting.alert_timeline(_samples(spark, sf), RULES, step_s=HOUR, lookback_s=LOOKBACK)


def _no_zone(df):
    return df.withColumns({c: F.col(c).cast(NTZ) for c, kind in df.dtypes if kind == "timestamp"})


@query(f"WITH {_TIMELINE} SELECT rule, series, t, round(value, 6) AS value, since, state FROM timeline", headline=True)
def alert_timeline(spark, sf):
    return _no_zone(_timeline(spark, sf).withColumn("value", F.round("value", 6)))


@query(f"WITH {_TRANSITIONS} SELECT rule, series, since, state, at_time FROM moves")
def alert_transitions(spark, sf):
    moves = alerting.alert_transitions(_timeline(spark, sf), HOUR)
    return _no_zone(moves.withColumnRenamed("at", "at_time"))


@query(f"""WITH {_TIMELINE} SELECT rule, series, t, CASE rule WHEN 'ErrorPeak' THEN 'error peak ' || printf('%.0f', round_even(value, 0))
    WHEN 'ErrorShare' THEN 'errors at ' || printf('%.0f', round_even(value, 0)) || '%'
    ELSE 'user ' || json_extract_string(series, '$.user_id') END AS summary,
    CASE WHEN rule = 'ErrorPeak' THEN 'critical' END AS severity FROM timeline WHERE state = 'firing'""")
def firing_alerts(spark, sf):
    fired = alerting.annotate(_timeline(spark, sf).where("state = 'firing'"), RULES)
    return _no_zone(fired).select(
        "rule", "series", "t", "summary", F.try_element_at("labels", F.lit("severity")).alias("severity")
    )


_CLAIM = {"persistentvolumeclaim": "data-mlflow-postgres-0"}
_ROOT_DISK = {"mountpoint": "/", "fstype": "ext4"}
# Event type -> samples made from it: metric, how its value is made, further labels.
_CLUSTER = {
    "error": [
        ("kube_job_failed", "bit", {"condition": "true"}),
        ("kube_pod_container_status_terminated_reason", "bit", {"reason": "OOMKilled"}),
        ("kube_pod_container_status_waiting_reason", "bit", {"reason": "CrashLoopBackOff"}),
        ("kube_job_status_failed", "bit", {}),
    ],
    "view": [
        ("container_memory_working_set_bytes", "value", {}),
        ("kubelet_volume_stats_used_bytes", "value", _CLAIM),
        ("probe_success", "not bit", {"job": "blackbox-mlflow-health"}),
        ("node_memory_MemAvailable_bytes", "value", {}),
        ("node_filesystem_avail_bytes", "value", _ROOT_DISK),
    ],
    "click": [
        ("kube_pod_container_resource_limits", "value", {"resource": "memory"}),
        ("kubelet_volume_stats_capacity_bytes", "value", _CLAIM),
        ("pg_up", "not bit", {}),
        ("node_memory_MemTotal_bytes", "more", {}),
        ("node_filesystem_size_bytes", "more", _ROOT_DISK),
    ],
    "purchase": [
        ("kube_job_status_succeeded", "bit", {}),
        ("kube_job_status_start_time", "start", {}),
        ("kube_job_status_completion_time", "end", {}),
        ("node_cpu_seconds_total", "value", {"mode": "idle", "cpu": "0"}),
        ("kube_node_status_condition", "bit", {"condition": "Ready", "status": "true"}),
    ],
    "signup": [
        ("kube_job_status_active", "bit", {}),
        ("kube_deployment_status_replicas_available", "value", {}),
        ("kube_deployment_status_replicas_unavailable", "bit", {}),
        ("kube_pod_status_phase", "bit", {"phase": "Pending"}),
        ("kube_pod_container_status_restarts_total", "value", {}),
    ],
}


def _cluster_samples(spark, sf):
    """Events renamed to the cluster metrics of the panels and rules, one pod per user.

    Errors are failed jobs, killed and crashing containers; views and clicks are memory,
    volume and health samples.
    """

    made = {
        kind: [{"metric": m, "how": how, "extra": extra} for m, how, extra in lines]
        for kind, lines in _CLUSTER.items()
    }
    recipes = F.from_json(
        F.lit(json.dumps(made)),
        "map<string, array<struct<metric:string, how:string, extra:map<string,string>>>>",
    )
    user = F.col("user_id").cast("string")
    bit = F.when(F.col("value") > 50, 1.0).otherwise(0.0)
    second = F.unix_seconds("ts").cast("double")
    value = (
        F.when(F.col("how") == "bit", bit)
        .when(F.col("how") == "not bit", 1.0 - bit)
        .when(F.col("how") == "more", F.col("value") + 100)
        .when(F.col("how") == "start", second)
        .when(F.col("how") == "end", second + F.col("value"))
        .otherwise(F.col("value"))
    )
    server = F.col("event_type").isin("view", "click")
    base = F.create_map(
        *[F.lit("namespace"), F.lit("prod"), F.lit("container"), F.lit("main")],
        *[F.lit("job_name"), F.lit("nightly"), F.lit("pod"), F.col("pod"), F.lit("deployment"), F.col("pod")],
        *[F.lit("instance"), F.col("instance")],
    )
    return (
        table(spark, sf, "events")
        .select(
            F.col("ts").cast("timestamp").alias("ts"),
            "value",
            F.concat(F.when(server, "mlflow-").otherwise("nightly-"), user).alias("pod"),
            F.concat(F.lit("node-"), F.substring(user, -1, 1)).alias("instance"),
            F.inline(F.try_element_at(recipes, F.col("event_type"))),
        )
        .select("metric", F.map_concat(base, "extra").alias("labels"), "ts", value.alias("value"))
    )


PANEL_TIME = "2024-01-20 00:00:00"
_RECIPE_SQL = ", ".join(
    f"('{kind}', '{metric}', '{how}')" for kind, lines in _CLUSTER.items() for metric, how, _ in lines
)
# Every metric comes from one event type, so a series is a metric and a user.
_NEWEST_SQL = f"""recipe(kind, metric, how) AS (VALUES {_RECIPE_SQL}),
    made AS (SELECT metric, user_id, ts, CASE how WHEN 'bit' THEN CAST(value > 50 AS DOUBLE)
        WHEN 'not bit' THEN 1.0 - CAST(value > 50 AS DOUBLE) WHEN 'more' THEN value + 100
        WHEN 'start' THEN CAST(floor(epoch_us(ts) / 1e6) AS DOUBLE)
        WHEN 'end' THEN CAST(floor(epoch_us(ts) / 1e6) AS DOUBLE) + value ELSE value END AS v
      FROM events JOIN recipe ON event_type = kind),
    s AS (SELECT metric, user_id, arg_max(v, ts) AS v FROM made WHERE ts <= TIMESTAMP '{PANEL_TIME}'
      AND ts >= TIMESTAMP '{PANEL_TIME}' - INTERVAL 5 DAY GROUP BY metric, user_id),
    t AS (SELECT metric, max(v) AS top, sum(v) AS total, CAST(count(*) AS DOUBLE) AS n FROM s GROUP BY metric),
    lines AS (SELECT metric, v, '{{"container":"main","deployment":"nightly-' || user_id || '","instance":"node-' ||
      right(CAST(user_id AS VARCHAR), 1) || '","job_name":"nightly","namespace":"prod","pod":"nightly-' || user_id || '"}}' AS labels
      FROM s)"""
_ONE_METRIC = {
    "nodes ready": ("kube_node_status_condition", "total"),
    "nodes not ready": ("kube_node_status_condition", "n - total"),
    "crash looping": ("kube_pod_container_status_waiting_reason", "total"),
    "failed jobs": ("kube_job_status_failed", "total"),
    "pods not running": ("kube_pod_status_phase", "total"),
    "tracker up": ("probe_success", "top"),
    "database up": ("pg_up", "top"),
    "last run succeeded": ("kube_job_status_succeeded", "top"),
    "last run failed": ("kube_job_status_failed", "top"),
    "last run started": ("kube_job_status_start_time", "top * 1000"),
    "out of memory": ("kube_pod_container_status_terminated_reason", "total"),
}
_TWO_METRICS = {
    "tracker memory": ("container_memory_working_set_bytes", "kube_pod_container_resource_limits", "100 * a.total / b.total"),
    "database volume": ("kubelet_volume_stats_used_bytes", "kubelet_volume_stats_capacity_bytes", "100 * a.total / b.total"),
    "last run seconds": ("kube_job_status_completion_time", "kube_job_status_start_time", "a.top - b.top"),
}
_SERIES_PANELS = {
    "unavailable replicas": ("kube_deployment_status_replicas_unavailable", "v > 0"),
    "jobs succeeded": ("kube_job_status_succeeded", "true"),
    "jobs failed": ("kube_job_status_failed", "true"),
    "jobs active": ("kube_job_status_active", "true"),
}
_PANELS_SQL = f"WITH {_NEWEST_SQL} " + " UNION ALL ".join(
    [
        f"SELECT '{panel}' AS panel, '{{}}' AS labels, round({value}, 6) AS value FROM t WHERE metric = '{metric}'"
        for panel, (metric, value) in _ONE_METRIC.items()
    ]
    + [
        f"SELECT '{panel}', '{{}}', round({value}, 6) FROM t a JOIN t b ON a.metric = '{one}' AND b.metric = '{two}'"
        for panel, (one, two, value) in _TWO_METRICS.items()
    ]
    + [
        f"SELECT '{panel}', labels, v FROM lines WHERE metric = '{metric}' AND {kept}"
        for panel, (metric, kept) in _SERIES_PANELS.items()
    ]
)


@query(_PANELS_SQL, headline=True)
def status_panels(spark, sf):
    """Every instant panel at one time, as (panel, labels, value)."""
    samples = _cluster_samples(spark, sf)
    at = F.lit(PANEL_TIME).cast("timestamp")
    panels = instant_panels(namespace="prod", job="nightly")
    found = panel_results(samples, panels, at, lookback_s=5 * 24 * HOUR)
    return found.withColumn("value", F.round("value", 6))


# Rule, its metrics and value per grid time, and its comparison.  Every duration is below the
# hourly step, so a rule fires at the second grid time of a run.
_STANDING = [
    ("PipelineJobFailed", "kube_job_failed", None, "a.top", "= 1"),
    ("PipelineJobOOMKilled", "kube_pod_container_status_terminated_reason", None, "a.top", "= 1"),
    ("MLflowDown", "probe_success", None, "a.top", "= 0"),
    ("MLflowMemoryHigh", "container_memory_working_set_bytes", "kube_pod_container_resource_limits", "100 * a.total / b.total", "> 90"),
    ("PostgresDown", "pg_up", None, "a.top", "= 0"),
    ("PostgresPVCAlmostFull", "kubelet_volume_stats_used_bytes", "kubelet_volume_stats_capacity_bytes", "100 * a.total / b.total", "> 85"),
]
_STANDING_SQL = f"""WITH {_NEWEST_SQL}, {_GRID},
    i AS (SELECT metric, user_id, t, arg_max(v, ts) AS v FROM made JOIN g ON ts <= t AND ts >= t - INTERVAL 6 HOUR GROUP BY ALL),
    x AS (SELECT metric, t, max(v) AS top, sum(v) AS total FROM i GROUP BY metric, t),
    held AS ({" UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{{}}' AS series, a.t FROM x a "
        + (f"JOIN x b ON b.t = a.t AND b.metric = '{two}' " if two else "")
        + f"WHERE a.metric = '{one}' AND {value} {test}"
        for rule, one, two, value, test in _STANDING
    )} UNION ALL SELECT 'KubePodCrashLooping', '{{"container":"main","deployment":"nightly-' || user_id || '","instance":"node-' ||
        right(CAST(user_id AS VARCHAR), 1) || '","job_name":"nightly","namespace":"prod","pod":"nightly-' || user_id ||
        '","reason":"CrashLoopBackOff"}}', t FROM made JOIN g ON ts <= t AND ts >= t - INTERVAL 1 HOUR
      WHERE metric = 'kube_pod_container_status_waiting_reason' GROUP BY user_id, t HAVING max(v) >= 1),
    starts AS (SELECT *, CASE WHEN t - lag(t) OVER w <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS s FROM held
      WINDOW w AS (PARTITION BY rule, series ORDER BY t)),
    islands AS (SELECT *, sum(s) OVER (PARTITION BY rule, series ORDER BY t) AS island FROM starts),
    runs AS (SELECT rule, series, min(t) AS since, max(t) AS last FROM islands GROUP BY rule, series, island)
    SELECT rule, series, since, 'pending' AS state, since AS at_time FROM runs
    UNION ALL SELECT rule, series, since, 'firing', since + INTERVAL 1 HOUR FROM runs WHERE last > since
    UNION ALL SELECT rule, series, since, CASE WHEN last > since THEN 'resolved' ELSE 'inactive' END, last + INTERVAL 1 HOUR FROM runs"""


@query(_STANDING_SQL)
def standing_rule_pack(spark, sf):
    """The eight standing rules over samples that the events stand in for."""
    # The events are hours apart, so the grid is hourly and no range is shorter than a step.
    rules = [
        replace(r, range_s=max(r.range_s, HOUR))
        for r in standing_rules(namespace="prod", job="nightly", watched_namespaces="prod|watch")
    ]
    samples = _cluster_samples(spark, sf)
    timeline = alerting.alert_timeline(samples, rules, step_s=HOUR, lookback_s=LOOKBACK)
    return _no_zone(alerting.alert_transitions(timeline, HOUR).withColumnRenamed("at", "at_time"))


def _labels_sql(**values) -> str:
    """A label map as its canonical text; values are SQL texts."""
    pairs = " || ',' || ".join(f"""'"{k}":"' || {v} || '"'""" for k, v in sorted(values.items()))
    return f"'{{' || {pairs} || '}}'"


_NODE = "'node-' || right(CAST(user_id AS VARCHAR), 1)"
_SERVER = {
    "namespace": "'prod'",
    "container": "'main'",
    "job_name": "'nightly'",
    "pod": "'mlflow-' || user_id",
    "deployment": "'mlflow-' || user_id",
    "instance": _NODE,
}
_DISK = {**_SERVER, "mountpoint": "'/'", "fstype": "'ext4'"}
_JOB_POD = _labels_sql(namespace="'prod'", pod="'nightly-' || user_id")
_DEPLOYMENT = _labels_sql(namespace="'prod'", deployment="'nightly-' || user_id")
_DAY_STRETCH = _STRETCH.replace("259200000000", "86400000000")


def _used_sql(panel: str, free: str, whole: str, labels_sql: str) -> str:
    return f"""SELECT '{panel}', a.t, {labels_sql}, 100 * (1 - a.v / b.v) FROM i a JOIN i b USING (user_id, t)
      WHERE a.metric = '{free}' AND b.metric = '{whole}'"""


def _total_sql(panel: str, metric: str, how: str, labels_sql: str = "'{}'") -> str:
    return f"SELECT '{panel}', t, {labels_sql}, {how}(v) FROM i WHERE metric = '{metric}' GROUP BY ALL"


_TREND_PARTS = [
    f"SELECT 'node cpu' AS panel, t, {_labels_sql(instance=_NODE)} AS labels, 100 * (1 - avg(grown / 86400.0)) AS value "
    "FROM c WHERE metric = 'node_cpu_seconds_total' GROUP BY ALL",
    f"SELECT 'restarts', t, {_JOB_POD}, grown FROM c WHERE metric = 'kube_pod_container_status_restarts_total'",
    _used_sql("node memory", "node_memory_MemAvailable_bytes", "node_memory_MemTotal_bytes", _labels_sql(**_SERVER)),
    _used_sql("node disk", "node_filesystem_avail_bytes", "node_filesystem_size_bytes", _labels_sql(**_DISK)),
    _total_sql("replicas available", "kube_deployment_status_replicas_available", "sum", _DEPLOYMENT),
    _total_sql("pods by phase", "kube_pod_status_phase", "sum", _labels_sql(phase="'Pending'")),
    _total_sql("tracker memory bytes", "container_memory_working_set_bytes", "sum"),
    _total_sql("runs succeeded", "kube_job_status_succeeded", "max"),
    _total_sql("runs failed", "kube_job_status_failed", "max"),
]
_TRENDS_SQL = f"""WITH {_NEWEST_SQL}, {_GRID},
    i AS (SELECT metric, user_id, t, arg_max(v, ts) AS v FROM made JOIN g ON ts <= t AND ts >= t - INTERVAL 6 HOUR GROUP BY ALL),
    days AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS t FROM (SELECT
      date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) + INTERVAL 25 HOUR AS hi FROM events)),
    d AS (SELECT *, epoch_us(ts) AS us, CASE WHEN v < lag(v) OVER w THEN v ELSE v - lag(v) OVER w END AS up FROM made
      WHERE metric IN ('node_cpu_seconds_total', 'kube_pod_container_status_restarts_total')
      WINDOW w AS (PARTITION BY metric, user_id ORDER BY ts)),
    f AS (SELECT metric, user_id, t, count(*) AS n, sum(up) - coalesce(arg_min_null(up, ts), 0) AS raw, arg_min(v, ts) AS v0,
      min(us) AS t0, max(us) AS t1, epoch_us(t) AS te FROM d JOIN days ON ts <= t AND ts >= t - INTERVAL 1 DAY GROUP BY ALL)
    {_DAY_STRETCH}, c AS (SELECT metric, user_id, t, raw * ((span + s1 + e0) / span) AS grown FROM z),
    p(panel, t, labels, value) AS ({" UNION ALL ".join(_TREND_PARTS)})
    SELECT panel, t, labels, round(value, 6) AS value FROM p"""


@query(_TRENDS_SQL)
def trend_panel_values(spark, sf):
    """Every trend panel on an hourly grid, as (panel, t, labels, value)."""
    panels = trend_panels(namespace="prod", job="nightly")
    values = panel_trends(_cluster_samples(spark, sf), panels, HOUR, LOOKBACK, range_s=24 * HOUR)
    return _no_zone(values.withColumn("value", F.round("value", 6)))


# ---------------------------------------------------------------- stages and runs

_STAGE_EVENTS = """se AS (SELECT 'run-' || user_id || '-' || CAST(ts AS DATE) AS run_id, 'user-' || user_id AS job,
    CASE WHEN value < 20 THEN 'split' ELSE 'train' END AS stage, CASE event_type WHEN 'view' THEN 'start' WHEN 'click' THEN 'start'
    WHEN 'signup' THEN 'interrupt' ELSE 'end' END AS kind, event_type = 'purchase' AS ok, ts FROM events),
    st AS (SELECT job, run_id, stage, min(ts) AS started FROM se WHERE kind = 'start' GROUP BY ALL),
    ends AS (SELECT st.*, kind, ok, ts, row_number() OVER (PARTITION BY run_id, stage ORDER BY ts, kind = 'interrupt', ok) AS rn
      FROM st JOIN se USING (job, run_id, stage) WHERE kind <> 'start' AND ts >= started),
    runs AS (SELECT st.job, st.run_id, st.stage, st.started,
      CASE WHEN kind = 'end' THEN (epoch_us(ts) - epoch_us(st.started)) / 1e6 END AS duration_seconds,
      CASE WHEN kind IS NULL OR kind = 'interrupt' THEN 'interrupted' WHEN ok THEN 'success' ELSE 'failure' END AS outcome
      FROM st LEFT JOIN ends ON ends.run_id = st.run_id AND ends.stage = st.stage AND rn = 1)"""


def stage_events(events):
    """Views and clicks start a stage, purchases end it well, errors badly, signups interrupt."""
    user = F.col("user_id").cast("string")
    kind = (
        F.when(F.col("event_type").isin("view", "click"), "start")
        .when(F.col("event_type") == "signup", "interrupt")
        .otherwise("end")
    )
    return events.select(
        F.concat(F.lit("run-"), user, F.lit("-"), F.date_format("ts", "yyyy-MM-dd")).alias("run_id"),
        F.concat(F.lit("user-"), user).alias("job"),
        F.when(F.col("value") < 20, "split").otherwise("train").alias("stage"),
        kind.alias("kind"),
        (F.col("event_type") == "purchase").alias("ok"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


@query(f"WITH {_STAGE_EVENTS} SELECT run_id, stage, started, round(duration_seconds, 6) AS duration_seconds, outcome FROM runs", headline=True)
def stage_durations(spark, sf):
    runs = stage_runs(stage_events(table(spark, sf, "events")))
    return _no_zone(runs.withColumn("duration_seconds", F.round("duration_seconds", 6)))


@query(f"""WITH {_STAGE_EVENTS}, newest AS (SELECT job, arg_max(run_id, (started, run_id)) AS run_id FROM runs GROUP BY job),
    domain(stage) AS (VALUES ('fetch_dataset'), ('preprocess'), ('split'), ('train'), ('evaluate'))
    SELECT n.job, n.run_id, d.stage, coalesce(r.outcome, 'not_run') AS outcome FROM newest n CROSS JOIN domain d
    LEFT JOIN runs r ON r.run_id = n.run_id AND r.stage = d.stage""")
def latest_run_stage_status(spark, sf):
    runs = stage_runs(stage_events(table(spark, sf, "events")))
    job = F.regexp_replace(F.regexp_extract("run_id", r"^run-(\d+)-", 1), "^", "user-")
    return stage_status(runs.withColumn("job", job))


_GAUGES = """p AS (SELECT 'user-' || user_id AS job, CASE event_type WHEN 'click' THEN 'split' WHEN 'view' THEN 'train'
    WHEN 'signup' THEN 'deploy' ELSE 'evaluate' END AS stage, value AS duration_seconds, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS success, ts FROM events),
    last AS (SELECT job, stage, arg_max(duration_seconds, ts) AS duration_seconds, arg_max(success, ts) AS success, max(ts) AS ts
      FROM p GROUP BY job, stage)"""


def gauge_pushes(events):
    return events.select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("job"),
        F.when(F.col("event_type") == "click", "split")
        .when(F.col("event_type") == "view", "train")
        .when(F.col("event_type") == "signup", "deploy")
        .otherwise("evaluate")
        .alias("stage"),
        F.col("value").alias("duration_seconds"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("success"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


@query(f"""WITH {_GAUGES} SELECT 'pipeline_stage_duration_seconds' AS metric, job, stage, ts, duration_seconds AS value, NULL AS text FROM last
    UNION ALL SELECT 'pipeline_stage_success', job, stage, ts, CAST(success AS DOUBLE), CASE success WHEN 1 THEN 'OK' ELSE 'FAILED' END FROM last""")
def stage_gauges(spark, sf):
    gauges = gauge_samples(newest_gauges(gauge_pushes(table(spark, sf, "events"))))
    text = F.when(
        F.col("metric").endswith("success"), display.map_value("value", display.OK_FAILED)
    )
    return gauges.select(
        "metric",
        labels.label("job").alias("job"),
        labels.label("stage").alias("stage"),
        F.col("ts").cast(NTZ).alias("ts"),
        "value",
        text.alias("text"),
    )
