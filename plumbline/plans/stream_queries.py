"""The streaming operators over the events as a stream of several files.

Each part is a micro-batch, some rows come up to 40 minutes out of order, and the last file
moves the watermark past the end; what it holds itself is never settled.  So all rows are
compared.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.operators import ranges
from plumbline.operators.chunks import floor_div
from plumbline.plans import metric_queries as mq
from plumbline.plans.registry import query
from plumbline.plans.tables import event_samples, table
from plumbline.session import shared_dir
from plumbline.sources.exposition import stream_sample_text
from plumbline.streaming.alerts import stream_alert_transitions
from plumbline.streaming.gauges import GaugeTable
from plumbline.streaming.jobs import drain, drain_batches
from plumbline.streaming.series import mark_late, stream_rate_grid, stream_series_lives
from plumbline.streaming.stages import stream_stage_runs
from plumbline.streaming.windows import tumbling

PARTS = 2
#: Rows of a file of the stream, about.
ROWS_A_FILE = 50_000
EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
# When a row arrives, and the part it arrives with, in SQL.
_ARRIVALS = f"""e AS (SELECT *, epoch_us(ts) AS us, epoch_us(ts) + (event_id % 5) * 600000000 AS arrives FROM events),
    b AS (SELECT min(us) AS lo, max(us) AS hi FROM e),
    p AS (SELECT e.*, least(((arrives - lo) * {PARTS}) // (hi - lo + 1), {PARTS - 1}) AS part FROM e, b)"""


def _events(spark, sf, change=None):
    """The events as a stream: written in parts, in the order of slightly wrong times.

    Each part is written by as many tasks as its rows need, into as many files, and a
    micro-batch takes that many files: one part.  ``change`` may replace the values first.
    """
    path = shared_dir(spark, "events")
    names = [c.split()[0] for c in EVENT_SCHEMA.split(", ")]
    rows = table(spark, sf, "events").select(*names)
    rows = rows if change is None else change(rows).select(*names)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = rows.agg(F.min(us).alias("lo"), F.max(us).alias("hi"), F.count("*").alias("n")).first()
    lo, hi = ends["lo"] or 0, ends["hi"] or 0
    files = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), ends["n"] // (PARTS * ROWS_A_FILE)))
    arrives = us + F.pmod("event_id", F.lit(5)) * 600_000_000
    part = F.least(floor_div((arrives - lo) * PARTS, hi - lo + 1), F.lit(PARTS - 1))
    # A null time fits no part; it goes with the first and is dropped by the stream.
    placed = rows.withColumn("_part", F.coalesce(part, F.lit(0)))
    for n in range(PARTS):
        placed.where(F.col("_part") == n).drop("_part").repartition(files).write.mode("append").parquet(path)
    # One row of each kind: filters are pushed below the watermark, so each must move its own.
    clock = F.timestamp_micros(F.lit(hi + 90 * 86_400_000_000)).cast("timestamp_ntz")
    closing = rows.select("event_type").distinct().select(
        F.lit(-1).cast("bigint").alias("event_id"),
        clock.alias("ts"),
        F.lit(None).cast("bigint").alias("user_id"),
        "event_type",
        F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("string").alias("props"),
    )
    closing.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files).parquet(path)


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS starts, event_type AS metric, count(*) AS n, max(value) AS largest
    FROM events GROUP BY ALL""")
def stream_tumbling(spark, sf):
    counts = tumbling(event_samples(_events(spark, sf)), 3600, ["metric"], delay="1 hour")
    return mq._no_zone(drain(counts, shared_dir(spark, "tumbling")))


@query(f"""WITH {mq._GRID} SELECT event_type AS metric, t, max(value) AS value FROM events
    JOIN g ON ts <= t AND ts >= t - INTERVAL 6 HOUR GROUP BY ALL""")
def stream_sliding_max(spark, sf):
    seen = event_samples(_events(spark, sf)).withWatermark("ts", "1 hour")
    peaks = ranges.over_time_grid(seen, mq.LOOKBACK, mq.HOUR, "max", keys=["metric"])
    return mq._no_zone(drain(peaks, shared_dir(spark, "sliding")))


@query(f"""WITH {mq._TRANSITIONS} SELECT rule, series, since, state, at_time FROM moves""")
def stream_alerts_equal_batch(spark, sf):
    moves = stream_alert_transitions(
        event_samples(_events(spark, sf)),
        mq.RULES,
        step_s=mq.HOUR,
        lookback_s=mq.LOOKBACK,
        delay="1 hour",
    )
    rows = drain(moves, shared_dir(spark, "alerts"))
    return mq._no_zone(rows.withColumnRenamed("at", "at_time"))


@query(f"""WITH {mq._GAUGES} SELECT job, stage, duration_seconds, CAST(success AS INTEGER) AS success, ts FROM last
    WHERE stage <> 'deploy'""")
def stream_gauges(spark, sf):
    """Gauges kept by a sink; a stage outside the list is refused."""
    root = shared_dir(spark, "gauges")
    gauges = GaugeTable(spark, f"{root}/table")
    drain_batches(mq.gauge_pushes(_events(spark, sf).where("event_id >= 0")), root, gauges.sink())
    return mq._no_zone(gauges.read())


@query(f"""WITH {mq._STAGE_EVENTS} SELECT run_id, stage, started, round(duration_seconds, 6) AS duration_seconds, outcome
    FROM runs""")
def stream_stage_durations(spark, sf):
    runs = stream_stage_runs(
        mq.stage_events(_events(spark, sf)).drop("job"), timeout_s=25 * 3600, delay="1 hour"
    )
    rows = drain(runs, shared_dir(spark, "stages"))
    return mq._no_zone(rows.withColumn("duration_seconds", F.round("duration_seconds", 6)))


def _count_of_the_day(rows):
    """Each row's place among its user's events of that kind and day: a counter with resets."""
    day = Window.partitionBy("event_type", "user_id", F.to_date("ts")).orderBy("ts")
    return rows.withColumn("value", F.row_number().over(day).cast("double"))


@query(f"""WITH {mq._COUNTER}, k AS (SELECT unnest(generate_series(lo, hi, INTERVAL 12 HOUR)) AS t FROM (SELECT
      date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) + INTERVAL 5 DAY AS hi FROM events)),
    f AS (SELECT metric, user_id, t, count(*) AS n, sum(grown) - coalesce(arg_min_null(grown, ts), 0) AS raw, arg_min(v, ts) AS v0,
      min(us) AS t0, max(us) AS t1, epoch_us(t) AS te FROM d JOIN k ON ts <= t AND ts >= t - INTERVAL 3 DAY GROUP BY ALL)
    {mq._STRETCH} SELECT metric, user_id, t, round(raw * ((span + s1 + e0) / span) / 259200.0 * 1e6, 6) AS per_second_e6 FROM z""")
def stream_counter_rate(spark, sf):
    """Counter growth per second on the grid, over a stream with rows out of order."""
    counted = _series_samples(_events(spark, sf, _count_of_the_day))
    rates = stream_rate_grid(counted, 72 * mq.HOUR, 12 * mq.HOUR, keys=["metric", "user_id"], delay="1 hour")
    rows = drain(rates, shared_dir(spark, "rates"))
    return mq._no_zone(rows.select("metric", "user_id", "t", F.round(F.col("value") * 1e6, 6).alias("per_second_e6")))


def _series_samples(events):
    return events.select(
        F.col("event_type").alias("metric"), F.col("user_id").cast("string").alias("user_id"), F.col("ts").cast("timestamp").alias("ts"), "value"
    )


@query("""WITH s AS (SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user_id, ts, value,
      lag(ts) OVER w AS before, lead(ts) OVER w AS after FROM events WINDOW w AS (PARTITION BY event_type, user_id ORDER BY ts, value))
    SELECT metric, user_id, 'appeared' AS event, ts, value FROM s WHERE before IS NULL OR ts - before > INTERVAL 7 DAY
    UNION ALL SELECT metric, user_id, 'forgotten', ts + INTERVAL 7 DAY, value FROM s WHERE after IS NULL OR after - ts > INTERVAL 7 DAY""")
def stream_last_values(spark, sf):
    """When each series becomes known, and when it is forgotten after 7 days without a sample."""
    lives = stream_series_lives(_series_samples(_events(spark, sf)), 7 * 24 * mq.HOUR, keys=["metric", "user_id"], delay="1 hour")
    rows = drain(lives, shared_dir(spark, "lives"))
    return mq._no_zone(rows.where("event <> 'seen' and user_id is not null"))


@query(f"""WITH {_ARRIVALS}, h AS (SELECT event_type, max(us) AS high FROM p WHERE part = 0 GROUP BY event_type)
    SELECT event_id, event_type, ts, CASE WHEN part > 0 AND high - us > 600000000 THEN (high - us) / 1e6 END AS late_by
    FROM p LEFT JOIN h USING (event_type)""")
def stream_late_samples(spark, sf):
    """All events, and by how much those lag that are more than 10 minutes behind their kind's newest."""
    events = _events(spark, sf).select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    rows = drain(mark_late(events, 600, keys=["event_type"]), shared_dir(spark, "late"))
    return mq._no_zone(rows.where("event_id >= 0").select("event_id", "event_type", "ts", "late_by"))


@query(mq._TEXT_SQL)
def stream_sample_lines(spark, sf):
    """The same lines of text as a stream of files."""
    path = shared_dir(spark, "text")
    mq.sample_text(spark, sf, path)
    parsed = stream_sample_text(spark, path, maxFilesPerTrigger=2)
    return mq.text_columns(drain(parsed, shared_dir(spark, "lines")))
