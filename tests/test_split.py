"""Exact, seeded, stratified splits and folds."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.errors import DataError
from plumbline.operators import assurance
from plumbline.operators.split import (
    hash_order,
    quotas,
    random_split,
    require_unique,
    stratified_kfold,
    stratified_split,
)


def frame(spark, rows, schema="g bigint, p bigint, y bigint"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def balanced(spark):
    return frame(spark, [(i, i % 7, i % 2) for i in range(40)]).cache()


def picked(df):
    return sorted((r["g"], r["partition"]) for r in df.select("g", "partition").collect())


def test_sizes_and_balance(balanced):
    got = stratified_split(balanced, "y", 0.25, 42, "g")
    counts = {(r["y"], r["partition"]): r["count"] for r in got.groupBy("y", "partition").count().collect()}
    assert counts == {(0, "test"): 5, (0, "train"): 15, (1, "test"): 5, (1, "train"): 15}


@pytest.mark.parametrize("rows,share,held", [(768, 0.2, 154), (614, 0.2, 123), (80, 0.25, 20)])
def test_published_sizes(rows, share, held):
    parts = quotas([(0, rows - rows // 3), (1, rows // 3)], share)
    assert sum(n for _, n in parts) == held


def test_layout_does_not_matter_but_the_seed_does(balanced):
    one = picked(stratified_split(balanced.repartition(1), "y", 0.25, 42, "g"))
    assert one == picked(stratified_split(balanced.repartition(13, "p"), "y", 0.25, 42, "g"))
    assert one == picked(stratified_split(balanced, "y", 0.25, 42, "g", prefix_digits=1))
    assert one != picked(stratified_split(balanced, "y", 0.25, 7, "g"))


def test_same_as_ranking_whole_classes(spark):
    rows = frame(spark, [(i, i % 3, 0 if i % 3 else i % 5) for i in range(501)])
    w = Window.partitionBy("y").orderBy(hash_order(1, ["g"]))
    sizes = [(r["y"], r["count"]) for r in rows.groupBy("y").count().orderBy("y").collect()]
    take = dict(quotas(sizes, 0.3))
    ranked = rows.withColumn("rk", F.row_number().over(w)).collect()
    want = sorted((r["g"], "test" if r["rk"] <= take[r["y"]] else "train") for r in ranked)
    assert want == picked(stratified_split(rows, "y", 0.3, 1, "g", prefix_digits=2))


def test_one_hot_class_is_still_exact(spark):
    rows = frame(spark, [(i, 0, 1 if i < 2 else 0) for i in range(1000)])
    got = stratified_split(rows, "y", 0.5, 3, "g", prefix_digits=1)
    counts = {(r["y"], r["partition"]): r["count"] for r in got.groupBy("y", "partition").count().collect()}
    assert counts == {(0, "test"): 499, (0, "train"): 499, (1, "test"): 1, (1, "train"): 1}


@pytest.mark.parametrize("share", [0.0, 1.0, -1, 1.5])
def test_share_out_of_range(balanced, share):
    with pytest.raises(DataError, match="stratify"):
        stratified_split(balanced, "y", share, 1, "g")


def test_errors(spark, balanced, sf):
    lonely = frame(spark, [(i, 0, 1 if i == 0 else 0) for i in range(5)])
    with pytest.raises(DataError, match="stratify"):
        stratified_split(lonely, "y", 0.4, 1, "g")
    with pytest.raises(DataError, match="nulls"):
        stratified_split(frame(spark, [(1, 1, None), (2, 1, 1), (3, 1, 1)]), "y", 0.5, 1, "g")
    with pytest.raises(DataError, match="missing column"):
        stratified_split(balanced, "Y", 0.2, 1, "g")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    with pytest.raises(DataError, match="not unique"):
        require_unique(lines, ["l_orderkey", "l_linenumber"])


def test_random_split_and_folds(balanced):
    parts = random_split(balanced, 0.2, 5, "g")
    assert parts.where("partition = 'test'").count() == 8
    folds = stratified_kfold(balanced, "y", 3, 5, "g")
    sizes = {(r["y"], r["fold"]): r["count"] for r in folds.groupBy("y", "fold").count().collect()}
    assert sizes == {(y, f): 7 if f < 2 else 6 for y in (0, 1) for f in range(3)}


def test_partition_checks(balanced):
    parts = stratified_split(balanced, "y", 0.25, 42, "g")
    train, test = parts.where("partition = 'train'"), parts.where("partition = 'test'")
    assert assurance.is_disjoint(train, test, "g")
    assert assurance.partition_overlap(parts, "g").isEmpty()
    assert assurance.coverage(parts).first()["complete"]
    assert assurance.coverage_gaps(balanced, [train, test], "g").isEmpty()
    assert not assurance.is_disjoint(parts, test, "g")
    # Equal contents under different keys are found by content.
    leaks = assurance.leakage(parts, ["p", "y"])
    assert leaks.count() > 0
    assert assurance.leakage(parts, ["g", "p", "y"]).isEmpty()


def test_digest_and_row_difference(spark, balanced):
    again = balanced.repartition(5).orderBy("p")
    for portable in (True, False):
        one = assurance.dataset_digest(balanced, portable=portable).first()
        assert one == assurance.dataset_digest(again, portable=portable).first()
        other = assurance.dataset_digest(balanced.where("g <> 3"), portable=portable).first()
        assert one != other
    assert assurance.same_rows(balanced, again)
    assert not assurance.same_rows(balanced, balanced.unionByName(balanced.limit(1)))
    empty = assurance.dataset_digest(balanced.where("false")).first()
    assert empty["n_rows"] == 0 and empty["hash_sum"] == "0"
