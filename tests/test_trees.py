"""Grown forests: every way gives the same trees, and a small tree equals a plain one."""

import random

import numpy as np
import pytest

from plumbline.errors import ConfigError, DataError
from plumbline.operators import trees
from plumbline.operators.trees import Fit, GrownForest, binned, fit_forest, fold_hits, grow_forests


def plain_tree(rows, y, n_classes, fit, cuts):
    """Nodes ``(path, feature, cut, size)`` by recursion over lists; all features at every node."""

    def purity(part):
        n = [sum(1 for i in part if y[i] == c) for c in range(n_classes)]
        return sum(v * v for v in n) / len(part)

    def visit(part, path):
        kinds = {y[i] for i in part}
        stop = len(kinds) < 2 or len(part) < fit.min_split or (fit.max_depth is not None and len(path) >= fit.max_depth)
        best = None
        if not stop:
            for f, edges in enumerate(cuts):
                for edge in edges:
                    low = [i for i in part if rows[i][f] <= edge]
                    high = [i for i in part if rows[i][f] > edge]
                    if min(len(low), len(high)) < fit.min_leaf:
                        continue
                    gain = round((purity(low) + purity(high)) / len(part), 12)
                    if best is None or gain > best[0]:
                        best = gain, f, edge, low, high
        if best is None:
            return [(path, None, None, len(part))]
        _, f, edge, low, high = best
        return [(path, f, edge, len(part)), *visit(low, path + "L"), *visit(high, path + "R")]

    return sorted(visit(range(len(rows)), ""))


def told(forest, number=0):
    tree, paths, out = forest.trees[number], {0: ""}, []
    for i in range(len(tree.feature)):
        f = tree.feature[i]
        if f >= 0:
            paths[tree.left[i]], paths[tree.right[i]] = paths[i] + "L", paths[i] + "R"
        out.append((paths[i], f if f >= 0 else None, forest.edges[f][tree.cut[i]] if f >= 0 else None, sum(tree.counts[i])))
    return sorted(out)


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([0.5, 1.0, 1.5, 7.0]), float(rng.randint(0, 9)), rng.random(), rng.choice(["a", "b", "c"])) for i in range(240)]
    rows = [(i, a, b, c, "a" if a > 1 and b > 4 and rng.random() < 0.9 else y) for i, a, b, c, y in rows]
    return rows, spark.createDataFrame(rows, "id long, x double, y double, z double, kind string")


@pytest.mark.parametrize("fit", [Fit(1, None, 2, 1, 3, bootstrap=False), Fit(1, 4, 20, 5, 3, bootstrap=False)])
@pytest.mark.parametrize("finish", [10_000, 60])
def test_a_small_tree_equals_a_plain_one(table, fit, finish):
    rows, df = table
    forest = fit_forest(df, ["x", "y", "z"], "kind", ["id"], fit, finish=finish)
    x = [r[1:4] for r in rows]
    cuts = [[(a + b) / 2 for a, b in zip(v[:-1], v[1:], strict=True)] for v in (sorted({r[f] for r in x}) for f in range(3))]
    want = plain_tree(x, [forest.classes.index(r[4]) for r in rows], 3, fit, cuts)
    got = told(forest)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert np.allclose([g[2] or 0 for g in got], [w[2] or 0 for w in want])


def test_all_ways_and_layouts_grow_the_same_forest(table, monkeypatch):
    _, df = table
    fits = [Fit(4, None, 5, 2, 2, seed=3), Fit(3, 3, 2, 1, 1, seed=4)]
    monkeypatch.setattr(trees, "CELLS", 1 << 13)
    monkeypatch.setattr(trees, "SENT", 300)
    texts = []
    for rows, finish in ((df, 10_000), (df.repartition(7, "z"), 40), (df.sort("z"), 3)):
        data = binned(rows, ["x", "y", "z"], "kind", ["id"])
        texts += [[GrownForest(data.features, data.edges, data.classes, f).describe() for f in grow_forests(data, fits, finish)]]
    assert texts[0] == texts[1] == texts[2]


def test_node_sizes_and_depth_are_kept(table):
    _, df = table
    data = binned(df, ["x", "y", "z"], "kind", ["id"])
    deep, shallow = grow_forests(data, [Fit(3, None, 2, 1, 3), Fit(3, None, 40, 8, 3)])
    for tree in shallow:
        for f, left, right in zip(tree.feature, tree.left, tree.right, strict=True):
            if f >= 0:
                assert min(sum(tree.counts[left]), sum(tree.counts[right])) >= 8
    assert max(len(t.feature) for t in shallow) < min(len(t.feature) for t in deep)
    # Without limits, every leaf is pure or holds rows that no feature tells apart.
    assert all(max(c) == sum(c) for t in deep for f, c in zip(t.feature, t.counts, strict=True) if f < 0)


def test_a_depth_beyond_any_limit(spark):
    # Labels alternate along the only feature, so a tree must come down to single rows.
    df = spark.range(200).selectExpr("id", "double(id) as x", "cast(id % 2 as int) as y")
    forest = fit_forest(df, ["x"], "y", ["id"], Fit(1, None, 2, 1, 1, bootstrap=False))
    assert max(len(path) for path, *_ in told(forest)) > 30 and len(forest.trees[0].feature) == 399
    assert forest.transform(df).where("prediction <> y").isEmpty()


def test_folds_are_left_out_and_scored(spark, table):
    _, df = table
    data = binned(df.selectExpr("*", "cast(id % 3 as int) as fold"), ["x", "y", "z"], "kind", ["id"], "fold")
    fits = [Fit(5, 5, 2, 1, 2, without_fold=f) for f in range(3)]
    forests = grow_forests(data, fits)
    for f, score in enumerate(fold_hits(data, fits, forests)):
        part = df.where(f"id % 3 = {f}")
        alone = fit_forest(df.where(f"id % 3 <> {f}"), ["x", "y", "z"], "kind", ["id"], Fit(5, 5, 2, 1, 2))
        other = GrownForest(data.features, data.edges, data.classes, forests[f])
        assert [sum(t.counts[0]) for t in alone.trees] == [sum(t.counts[0]) for t in other.trees]
        hits = other.transform(part).where("prediction = kind").count()
        assert score == pytest.approx(hits / part.count())


def test_a_forest_is_stored_and_read(spark, table, tmp_path):
    _, df = table
    forest = fit_forest(df, ["x", "y", "z"], "kind", ["id"], Fit(4, None, 2, 1, 2))
    forest.save(spark, str(tmp_path / "f"))
    again = GrownForest.load(spark, str(tmp_path / "f"))
    assert again.describe() == forest.describe()
    odd = spark.createDataFrame([(None, 1.0, 2.0), (1.0, float("nan"), 2.0), (1.0, 1.0, 2.0)], "x double, y double, z double")
    assert [r.prediction is None for r in again.transform(odd).collect()] == [True, True, False]


def test_many_values_are_binned_at_even_shares(spark):
    df = spark.range(5000).selectExpr("id", "exp(rand(1) * 9) as x", "cast(id % 2 as int) as y")
    data = binned(df, ["x"], "y", ["id"], bins=16)
    sizes = [r["n"] for r in data.rows.groupBy("bins").count().withColumnRenamed("count", "n").collect()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * min(sizes)


def test_what_cannot_be_learnt_is_refused(spark):
    df = spark.createDataFrame([(1, 1.0, 0), (2, None, 1)], "id int, x double, y int")
    with pytest.raises(DataError, match="null"):
        binned(df, ["x"], "y", ["id"])
    with pytest.raises(DataError, match="no rows"):
        binned(df.limit(0), ["x"], "y", ["id"])
    with pytest.raises(DataError, match="classes"):
        binned(spark.range(200).selectExpr("id", "double(id) x", "id as y"), ["x"], "y", ["id"])
    with pytest.raises(ConfigError):
        Fit(min_split=1)
    one = fit_forest(df.where("x is not null"), ["x"], "y", ["id"], Fit(2))
    assert [len(t.feature) for t in one.trees] == [1, 1]


@pytest.mark.parametrize("finish", [1 << 16, 40])
def test_equal_rows_of_several_classes_end_in_mixed_leaves(spark, finish):
    rows = [(i, float(i % 2), i % 3 % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, x double, y int")
    fit = Fit(3, None, 2, 1, 1, 5)
    forest = fit_forest(df, ["x"], "y", ["id"], fit, finish=finish)
    assert [t.feature for t in forest.trees] == [[0, -1, -1]] * 3
    assert all(min(leaf) > 0 for t in forest.trees for leaf in t.counts)
    alone = fit_forest(df.where("x = 0"), ["x"], "y", ["id"], fit, finish=finish)
    assert [t.feature for t in alone.trees] == [[-1]] * 3
