"""Rows, files and classes that must not vanish without a word."""

import pytest

from plumbline.errors import DataError
from plumbline.operators import assurance, classmetrics, forest, secrets, split
from plumbline.sources import datasets, manifests
from plumbline.sources.ledger import RunLedger


def test_a_metrics_table_of_several_rows_is_refused(spark, tmp_path):
    with pytest.raises(DataError, match="one row"):
        datasets.write_metrics_json(spark.range(3), str(tmp_path / "m"))
    with pytest.raises(DataError, match="one row"):
        datasets.write_metrics_json(spark.range(0), str(tmp_path / "m"))


def test_folds_refuse_a_null_target(spark):
    df = spark.createDataFrame([(i, None if i < 3 else i % 2) for i in range(20)], "id int, y int")
    with pytest.raises(DataError, match="nulls"):
        split.stratified_kfold(df, "y", 3, 1, "id")


def test_composite_keys_with_separators_do_not_tie(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "x string, y string")
    assert df.select(split.hash_order(1, ["x", "y"]).alias("h")).distinct().count() == 2
    held = split.random_split(df, 0.5, 1, ["x", "y"]).where("partition = 'test'").count()
    assert held == 1


def test_a_run_keeps_its_training_and_its_evaluation(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "ledger"))
    for _ in range(2):
        ledger.log_training_run("r1", params={"n": 1}, best_params={"leaf": 2}, metrics={"accuracy": 0.5})
        ledger.log_evaluation("r1", {"accuracy": 0.25, "rows": 9})
    runs = {(r.run_id, r.stage) for r in ledger.read("runs").collect()}
    assert runs == {("r1", "train"), ("r1", "evaluate")}
    metrics = sorted((r.stage, r.name, r.value) for r in ledger.read("run_metrics").collect())
    assert metrics == [("evaluate", "accuracy", 0.25), ("evaluate", "rows", 9.0), ("train", "accuracy", 0.5)]


def test_nulls_count_alike_in_all_class_metrics(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (None, 1), (1, None)], "label int, prediction int")
    assert classmetrics.accuracy(df).first().accuracy == 0.5
    cells = classmetrics.confusion_matrix(df).collect()
    assert len(cells) == 9 and sum(c.n for c in cells) == 4
    assert classmetrics.confusion_matrix(df, dense=False).count() == 4
    report = {r["class"]: r for r in classmetrics.classification_report(df).collect()}
    assert report["accuracy"].support == 4 and report["accuracy"].precision == 0.5


def test_files_of_a_folder_must_have_the_same_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n10,20\n")
    with pytest.raises(DataError, match="header"):
        datasets.read_dataset(spark, str(tmp_path), "x int, y int")


@pytest.mark.parametrize("portable", [False, True])
def test_digests_tell_nulls_and_separators_apart(spark, portable):
    def digest(rows):
        return assurance.dataset_digest(spark.createDataFrame(rows, "x string, y string"), portable=portable).first()

    pairs = [([(None, "5")], [("5", None)]), ([("x|y", "z")], [("x", "y|z")]), ([("\\N", "a")], [(None, "a")])]
    for one, other in pairs:
        assert digest(one) != digest(other)
    assert digest([("a", "b"), ("c", None)]) == digest([("c", None), ("a", "b")])


def test_an_empty_file_has_a_row_and_meets_its_pin(spark, tmp_path):
    (tmp_path / "full file.txt").write_text("hello")
    (tmp_path / "empty.txt").write_text("")
    got = {r.path.rsplit("/", 1)[1]: r for r in manifests.file_manifest(spark, str(tmp_path)).collect()}
    assert set(got) == {"full%20file.txt", "empty.txt"}
    assert got["empty.txt"].length == 0
    assert got["empty.txt"].sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_a_refused_file_is_not_parsed(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "good one.csv").write_text("a,b\n1,2\n")
    (source / "bad.csv").write_text("a,b\n1,2,3,x\n")
    rows = manifests.file_manifest(spark, str(source)).collect()
    pins = [(r.path, r.sha256 if "good" in r.path else "0" * 64) for r in rows]
    dest = str(tmp_path / "out")
    manifests.land_dataset(spark, str(source), dest, spark.createDataFrame(pins, "path string, sha256 string"), schema="a int, b int")
    assert [tuple(r) for r in spark.read.parquet(dest).collect()] == [(1, 2)]


def test_every_failed_file_is_counted(spark):
    rows = [(f"f{i}", "mismatch", "a", "b") for i in range(45)]
    with pytest.raises(DataError, match="45 file"):
        manifests.require_verified(spark.createDataFrame(rows, "path string, status string, actual_sha256 string, expected_sha256 string"))


def test_documents_are_walked_to_any_depth_and_broken_ones_are_shown(spark):
    deep = '{"a":' * 9 + '"x"' + "}" * 9
    rows = [(1, deep), (2, "{oops"), (3, "7"), (4, None), (5, "{}"), (6, "[1,[2]]")]
    got = {(r.id, r.path, r.value, r.status) for r in secrets.walk_strings(spark.createDataFrame(rows, "id int, doc string"), "id", "doc").collect()}
    assert got == {
        (1, ".".join("a" * 9), "x", "ok"), (2, None, "{oops", "malformed"), (3, "", "7", "ok"),
        (6, "[0]", "1", "ok"), (6, "[1][0]", "2", "ok"),
    }


def test_two_trainings_are_equal_whatever_the_layout(spark):
    df = spark.range(600).selectExpr("id", "sin(id) as x", "id % 17 as z", "cast(sin(id) + id % 17 > 8 as int) as y")
    settings = forest.ForestSettings(n_trees=5, max_depth=4, seed=3, leaf_sizes=(1,), split_sizes=(2,))
    texts = []
    for rows in (df, df.repartition(7, "z").sortWithinPartitions("x")):
        spark.range(1000).selectExpr("sum(id)").collect()
        texts.append(forest.grid_search(rows, "y", "id", settings).model.describe())
    assert texts[0] == texts[1]


def test_a_reloaded_model_checks_what_it_is_given(spark, tmp_path):
    from plumbline.errors import ModelError
    from plumbline.plans.learning import load_fitted, save_fitted

    df = spark.range(200).selectExpr("id", "sin(id) as x", "cast(sin(id) > 0 as int) as y")
    settings = forest.ForestSettings(n_trees=3, max_depth=3, seed=1, leaf_sizes=(1,), split_sizes=(2,))
    fitted = forest.grid_search(df, "y", "id", settings)
    save_fitted(fitted, spark, str(tmp_path / "m"))
    again = load_fitted(spark, str(tmp_path / "m"))
    assert (again.target, again.signature, again.output, again.best_params) == (fitted.target, fitted.signature, fitted.output, fitted.best_params)
    one, other = (sorted(map(tuple, forest.predict(f, df).collect())) for f in (fitted, again))
    assert one == other and forest.predict(again, df.drop("y")).schema["prediction"].dataType.simpleString() == "int"
    for wrong in (df.drop("x"), df.withColumn("x", df.x.cast("string")), df.withColumn("y", df.y.cast("string"))):
        with pytest.raises(ModelError):
            forest.predict(again, wrong)
    with pytest.raises(ModelError, match="not found"):
        load_fitted(spark, str(tmp_path / "none"))
