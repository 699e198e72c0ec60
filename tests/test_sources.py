"""Reading, writing, manifests, ledger, logs and models: results and error paths."""

import pytest
from pyspark.sql import functions as F

from plumbline.errors import ConfigError, DataError, ModelError
from plumbline.operators import columns, forest, secrets
from plumbline.plans import learning
from plumbline.sources import datasets, manifests
from plumbline.sources.ledger import RunLedger
from plumbline.sources.logs import read_log_entries

SCHEMA = "a bigint, b double"


def put(tmp_path, text, name="d.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, 'x "q", y', None), (2, None, None, "z")], "a int, b double, s string, t string")
    path = str(tmp_path / "deep" / "er" / "out")
    datasets.write_dataset(df, path, "csv")
    back = datasets.read_dataset(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


@pytest.mark.parametrize(
    "text,message",
    [
        ("", "empty"),
        ("a,a\n1,2\n", "duplicate"),
        ("a,c\n1,2\n", "does not match"),
        ("a,b\n1,2,3\n", "malformed"),
        ("a,b\n1\n", "malformed"),
        ("a,b\nx,2\n", "malformed"),
    ],
)
def test_csv_errors(spark, tmp_path, text, message):
    with pytest.raises(DataError, match=message):
        datasets.read_dataset(spark, put(tmp_path, text), SCHEMA)


def test_csv_other_cases(spark, tmp_path):
    with pytest.raises(DataError, match="not found"):
        datasets.read_dataset(spark, str(tmp_path / "none.csv"))
    assert datasets.read_dataset(spark, put(tmp_path, "a,b\n"), SCHEMA).count() == 0
    with pytest.raises(DataError, match="missing column"):
        datasets.read_dataset(spark, put(tmp_path, "a,b\n1,2\n"), required=["Outcome"])
    assert dict(datasets.read_dataset(spark, put(tmp_path, "a,b\n1,2.5\n")).dtypes) == {"a": "int", "b": "double"}
    path = put(tmp_path, "a,b\n1,2\n3,4,5\n")
    good, bad = datasets.split_malformed(datasets.read_dataset(spark, path, SCHEMA, malformed="keep"))
    assert [tuple(r) for r in good.collect()] == [(1, 2.0)] and (good.count(), bad.count()) == (1, 1)
    with pytest.raises(Exception, match="malformed row"):
        datasets.read_dataset(spark, path, SCHEMA, malformed="fail").collect()
    with pytest.raises(ConfigError):
        datasets.read_dataset(spark, path, SCHEMA, malformed="?")


def test_metrics_json(spark, tmp_path):
    path = str(tmp_path / "m")
    datasets.write_metrics_json(spark.createDataFrame([(0.5, 3)], "b double, a int"), path)
    assert [r[0] for r in spark.read.text(path).collect()] == ['{"a":3,"b":0.5}']
    with pytest.raises(DataError):
        datasets.write_metrics_json(spark.createDataFrame([([1],)], "x array<int>"), path)


def test_columns(spark):
    df = spark.createDataFrame([(1, 2)], "Glucose int, Outcome int")
    assert columns.features_target(df, "Outcome") == (["Glucose"], "Outcome")
    with pytest.raises(DataError, match="outcome"):
        columns.require_columns(df, ["outcome"], "x")
    stages = spark.createDataFrame([("train",), ("deploy",), (None,)], "stage string")
    ok, refused = columns.allow_values(stages, "stage")
    assert ok.count() == 1 and refused.count() == 2


def test_manifest_of_files(spark, tmp_path):
    import hashlib

    blobs = {"a.bin": b"x" * 3_000_000, "b c.bin": b"y", "d.txt": b"skip"}
    for name, data in blobs.items():
        (tmp_path / name).write_bytes(data)
    small = manifests.file_manifest(spark, str(tmp_path), "*.bin").orderBy("path").collect()
    large = manifests.large_file_manifest(spark, str(tmp_path), "*.bin").orderBy("path").collect()
    assert small == large
    assert [r["sha256"] for r in small] == [
        hashlib.sha256(blobs[n]).hexdigest() for n in ("a.bin", "b c.bin")
    ]
    frame = spark.createDataFrame(small)
    assert manifests.is_unchanged(frame, frame)
    wrong = frame.select("path", F.md5("path").alias("sha256"))
    with pytest.raises(DataError, match="mismatch"):
        manifests.require_verified(manifests.verify_manifest(frame, wrong))
    none = frame.select("path", F.lit(" ").alias("sha256"))
    assert {r["status"] for r in manifests.verify_manifest(frame, none).collect()} == {"unpinned"}


def test_both_manifests_name_files_alike(spark, tmp_path):
    for name in ("day=1/a b.bin", "day=1/é,ü (1).bin", "漢 字+&@;'!~$.bin", "50%25#1?.bin", "empty.bin"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"" if name == "empty.bin" else name.encode())
    small = manifests.file_manifest(spark, str(tmp_path)).orderBy("path").collect()
    assert len(small) == 5
    assert small == manifests.large_file_manifest(spark, str(tmp_path)).orderBy("path").collect()


def test_landing(spark, tmp_path):
    source, dest = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "good.csv").write_text("a,b\n1,2\n")
    (source / "bad.csv").write_text("a,b\n3,4\n")
    (source / "free.csv").write_text("a,b\n5,6\n")
    files = manifests.file_manifest(spark, str(source))
    pins = files.where(~F.col("path").contains("free")).select(
        "path",
        F.when(F.col("path").contains("bad"), F.md5("path")).otherwise(F.upper("sha256")).alias("sha256"),
    )
    verified = manifests.land_dataset(spark, str(source), dest, pins, schema=SCHEMA)
    status = {r["path"].rsplit("/", 1)[1]: r["status"] for r in verified.collect()}
    assert status == {"good.csv": "ok", "bad.csv": "mismatch", "free.csv": "unpinned"}
    assert {r["a"] for r in spark.read.parquet(dest).collect()} == {1, 5}
    with pytest.raises(DataError, match="mismatch"):
        manifests.land_dataset(spark, str(source), str(tmp_path / "x"), pins, schema=SCHEMA, strict=True)
    assert not (tmp_path / "x").exists() and (tmp_path / "x_verified").exists()


def test_ledger(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "ledger"))
    assert ledger.read("runs").isEmpty()
    for _ in range(2):
        ledger.log_evaluation("r1", {"accuracy": 0.75}, "  ")
        ledger.log_training_run(
            "r2", params={"seed": 1}, best_params={"min_leaf": 2}, metrics={"accuracy": 0.5}, artifacts={"report": "x"}
        )
    assert {(r["run_id"], r["experiment"], r["stage"]) for r in ledger.read("runs").collect()} == {
        ("r1", "default", "evaluate"),
        ("r2", "default", "train"),
    }
    assert {(r["name"], r["value"]) for r in ledger.read("run_params").collect()} == {("seed", "1"), ("best_min_leaf", "2")}
    assert ledger.read("run_metrics").count() == 2
    assert ledger.log_evaluation(None, {}) != ledger.log_evaluation(None, {})
    with pytest.raises(ConfigError):
        ledger.read("nothing")


def test_log_entries_keep_their_traceback(spark, tmp_path):
    put(
        tmp_path,
        "loose line\n"
        "2026-08-01 18:53:39 | INFO     | preprocess | 768 rows written\n"
        "2026-08-01 18:53:40 | ERROR    | train | failed | badly\n"
        "Traceback:\n  at x\n"
        "2026-08-01 18:53:41 | WARNING  | split | ok\n",
        "run.log",
    )
    rows = read_log_entries(spark, str(tmp_path)).collect()
    assert [(r["level"], r["stage"], r["message"], r["continuation"]) for r in rows if r["stage"] == "train"] == [
        ("ERROR", "train", "failed | badly", False),
        ("ERROR", "train", "Traceback:", True),
        ("ERROR", "train", "  at x", True),
    ]
    assert sum(r["stage"] is None for r in rows) == 1 and len(rows) == 6


def test_secrets(spark):
    rows = [
        (1, 'db_password = "hunter22"\nAPI-KEY="changeme" token = ""'),
        (2, "nothing = \"here\" but AKIA" + "ABCDEFGHIJKLMNOP and ghp_" + "a" * 20),
        (3, None),
    ]
    df = spark.createDataFrame(rows, "id int, text string")
    found = secrets.credential_literals(df, "id", "text").collect()
    assert [(r["id"], r["name"]) for r in found] == [(1, "db_password")]
    kinds = {(r["id"], r["kind"]) for r in secrets.secret_fingerprints(df, "id", "text").collect()}
    assert kinds == {(2, "AWS access key id"), (2, "GitHub token")}
    doc = spark.createDataFrame([(1, '{"a":{"b":[1,"x"]},"c":"y","d":null}')], "id int, doc string")
    walked = {(r["path"], r["value"]) for r in secrets.walk_strings(doc, "id", "doc").collect()}
    assert walked >= {("a.b[0]", "1"), ("a.b[1]", "x"), ("c", "y")}
    with pytest.raises(Exception, match="nested deeper"):
        secrets.walk_strings(doc, "id", "doc", depth=2).collect()


def test_training_run(spark, tmp_path):
    rows = [(i, float(i), float(i % 5), int(i >= 30)) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, glucose double, pressure double, outcome int")
    settings = forest.ForestSettings(n_trees=3, max_depth=None, seed=1, leaf_sizes=(1,), split_sizes=(2, 40))
    training, scored = learning.holdout_run(df, "outcome", "id", settings=settings)
    assert training.fitted.best_params["min_split"] == 2 and scored.count() == 12
    assert training.validation.count() == 10
    ledger = RunLedger(spark, str(tmp_path / "l"))
    learning.record_training(training, settings, ledger, "t1")
    assert {r["name"] for r in ledger.read("run_artifacts").collect()} >= {"classification_report", "signature"}
    with pytest.raises(ModelError, match="held-out"):
        learning.evaluate_model(training.fitted, df.drop("glucose"))
    path = str(tmp_path / "model")
    datasets.save_model(training.fitted.model, path)
    again = datasets.load_model(spark, path).transform(df).select("id", "prediction")
    assert again.join(forest.predict(training.fitted, df).withColumnRenamed("prediction", "p"), "id").where("p <> prediction").isEmpty()
    with pytest.raises(ModelError, match="not found"):
        datasets.load_model(spark, str(tmp_path / "nowhere"))
    (tmp_path / "broken").mkdir()
    with pytest.raises(ModelError, match="corrupt"):
        datasets.load_model(spark, str(tmp_path / "broken"))


def test_ties_go_to_the_first_candidate():
    scores = [(0, {"x": 1}, 0.5), (1, {"x": 2}, 0.7), (2, {"x": 3}, 0.7)]
    assert forest.best_candidate(scores)[0] == 1


def test_a_local_file_is_never_one_row(spark, tmp_path):
    from gzip import compress
    from hashlib import md5, sha256

    data = {"big one%.bin": bytes(range(256)) * 9000, "small.bin": b"x", "empty.bin": b"", "zipped.bin.gz": compress(b"z"), "other.txt": b"y"}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    most = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(most)
    spark.conf.set(most, "1000")
    try:
        rows = manifests.file_manifest(spark, str(tmp_path), "*.bin*").collect()
    finally:
        spark.conf.set(most, before)
    want = {(len(c), md5(c).hexdigest(), sha256(c).hexdigest()) for n, c in data.items() if ".bin" in n}
    assert len(rows) == 4 and {(r["length"], r["md5"], r["sha256"]) for r in rows} == want
    assert {r["path"] for r in rows} == {f"file:{tmp_path}/{n}" for n in ("big%20one%25.bin", "small.bin", "empty.bin", "zipped.bin.gz")}
