"""The small pieces: scalars, recording, display order, running gauges."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline.errors import ConfigError, DataError
from plumbline.functions import display, scalars
from plumbline.operators import alerting, assurance
from plumbline.operators.split import rank_in_class
from plumbline.plans import learning
from plumbline.plans.rulepack import standing_rules
from plumbline.sources.datasets import run_metric_rows
from plumbline.sources.ledger import RunLedger
from plumbline.sources.synthetic import Feature, interleaved, labelled_features
from plumbline.streaming.gauges import stream_last_values
from plumbline.streaming.jobs import drain_batches


def one(spark, **columns):
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return row.asDict()


def test_scalars(spark):
    got = one(
        spark,
        half=scalars.percent_text(F.lit(90.5)),
        odd=scalars.percent_text(F.lit(91.5)),
        four=scalars.decimals_text(F.lit(0.70779)),
        even=scalars.round_even(F.lit(0.125), 2),
        share=scalars.percent_of(F.lit(1.0), F.lit(4.0)),
        none=scalars.percent_of(F.lit(1.0), F.lit(0.0)),
        text=scalars.template("{a}-{gone} at {value}%", F.create_map(F.lit("a"), F.lit("x")), F.lit(92.2)),
        present=scalars.config_has(F.lit('{"a":{"b":null}}'), "a.b"),
        missing=scalars.config_has(F.lit('{"a":{"b":null}}'), "a.c"),
        null=scalars.config_value(F.lit('{"a":{"b":null}}'), "a.b"),
        band=display.band(F.lit(80.0), [(None, "ok"), (80, "warn"), (90, "bad")]),
        unmapped=display.map_value(F.lit(None).cast("double"), display.UP_DOWN),
    )
    assert got == {
        "half": "90",
        "odd": "92",
        "four": "0.7078",
        "even": 0.12,
        "share": 25.0,
        "none": None,
        "text": "x- at 92%",
        "present": True,
        "missing": False,
        "null": None,
        "band": "warn",
        "unmapped": None,
    }


@pytest.mark.parametrize(
    "uri,want",
    [
        ("s3://bucket/key.csv", ("bucket", "key.csv")),
        ("S3://bucket//a/b.csv?x=1#y", ("bucket", "a/b.csv")),
        ("s3://bucket/", None),
        ("s3://bucket", None),
        ("s3:///key", None),
        ("https://bucket/key", None),
        ("bucket/key", None),
        ("", None),
        (None, None),
    ],
)
def test_uri_parts(spark, uri, want):
    found = one(spark, p=scalars.uri_parts(F.lit(uri).cast("string")))["p"]
    assert (found and tuple(found)) == want


def test_checks_and_recording(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "id int, ok int")
    checks = assurance.run_expectations(df, [assurance.Expectation("s", "ok is 1", F.col("ok") == 1)])
    assert checks.first()["failed_rows"] == 2
    with pytest.raises(DataError, match="s/ok is 1: 2 row"):
        assurance.require_all_ok(checks)
    assurance.require_all_ok(checks.where("ok"))
    learning.audit_inputs(df.where("id < 2"), df.where("id > 1"), "id")
    with pytest.raises(DataError, match="share rows"):
        learning.audit_inputs(df, df.where("id > 1"), "id")
    ledger = RunLedger(spark, str(tmp_path / "ledger"))
    scored = spark.createDataFrame([(0.75,)], "accuracy double")
    learning.record_evaluation(scored, str(tmp_path / "m"), ledger, "r")
    assert json.loads(spark.read.text(str(tmp_path / "m")).first()[0]) == {"accuracy": 0.75}
    rows = run_metric_rows(scored, F.lit("r"), "evaluate").collect()
    assert [tuple(r) for r in rows] == [("r", "evaluate", "accuracy", 0.75)]
    assert ledger.newest_metric("accuracy").first()["value"] == 0.75


def test_seeded_data_ignores_layout_and_interleaves(spark):
    keys = spark.range(60).select("id", (F.col("id") % 2).alias("y"))
    features = [Feature("g", 100, 10, shift=30), Feature("b", 20, 5, digits=1, uniform=True)]
    one_way = labelled_features(keys, "id", "y", features, 7)
    other = labelled_features(keys.repartition(5), "id", "y", features, 7)
    assert assurance.same_rows(one_way, other)
    assert one_way.where("b < 15 or b > 25").isEmpty()
    means = {r["y"]: r["m"] for r in one_way.groupBy("y").agg(F.avg("g").alias("m")).collect()}
    assert means[1] - means[0] > 15
    order = interleaved(rank_in_class(keys, "y", 1, ["id"], 1), "y").select("y").collect()
    assert [r["y"] for r in order] == [0, 1] * 30


def test_rules_are_checked_and_seen_at_one_time(make_samples):
    with pytest.raises(ConfigError):
        alerting.AlertRule("x", "ratio", standing_rules(namespace="n", job="j", watched_namespaces="n")[0].select, ">", 1, 1)
    rules = standing_rules(namespace="n", job="j", watched_namespaces="n")
    timeline = alerting.alert_timeline(make_samples([("pg_up", {}, [0] * 8)]), rules, step_s=60)
    at = F.lit("2026-01-01 00:05:00").cast("timestamp")
    assert [r["rule"] for r in alerting.firing_at(timeline, at).collect()] == ["PostgresDown"]


def test_running_gauges(spark, make_samples, tmp_path):
    path = str(tmp_path / "in")
    make_samples([("m", {}, [1, 5, 3])]).select("metric", "ts", "value").write.parquet(path)
    stream = spark.readStream.schema("metric string, ts timestamp, value double").parquet(path)
    seen = []
    drain_batches(
        stream_last_values(stream, ["metric"]),
        str(tmp_path / "work"),
        lambda batch, _: seen.extend((r["metric"], r["value"]) for r in batch.collect()),
    )
    assert seen[-1] == ("m", 3.0)
