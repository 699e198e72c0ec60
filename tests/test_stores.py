"""Lineage closure, hash trees, commits, file digests and text samples."""

import hashlib
import random
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from plumbline.errors import ConfigError, DataError
from plumbline.operators import hashtree, lineage
from plumbline.sources import manifests
from plumbline.sources.commits import CommitLog, checked_key
from plumbline.sources.exposition import parse_samples, read_sample_text, sample_lines, stream_sample_text, write_sample_text
from plumbline.streaming.jobs import drain


def plain_reach(edges):
    out = {}
    for a, b in edges:
        if a is not None and b is not None:
            out.setdefault(a, set()).add(b)
    pairs = set()
    for start in out:
        waiting, seen = list(out[start]), set()
        while waiting:
            node = waiting.pop()
            if node not in seen:
                seen.add(node)
                waiting += out.get(node, ())
        pairs |= {(start, n) for n in seen}
    return pairs


def test_closure_equals_a_plain_search(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(50)] + [(100 + i, 100 + (i + 1) % 7) for i in range(7)] + [(200, 200), (None, 3), (3, None), (0, 1)]
    edges += [(300 + rng.randint(0, 15), 300 + rng.randint(0, 15)) for _ in range(20)]
    got = [tuple(r) for r in lineage.closure(spark.createDataFrame(edges, "source int, target int")).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_reach(edges)
    assert lineage.closure(spark.createDataFrame([], "source int, target int")).isEmpty()


def test_leaks_over_several_stages_are_found(spark):
    rows = [
        ("split", "raw", "dep"), ("split", "train", "out"), ("split", "test", "out"), ("peek", "test", "dep"), ("peek", "notes", "out"),
        ("enrich", "notes", "dep"), ("enrich", "train", "dep"), ("enrich", "train2", "out"), ("fit", "train2", "dep"), ("fit", "model", "out"),
        ("score", "model", "dep"), ("score", "test", "dep"),
    ]
    steps = spark.createDataFrame(rows, "stage string, artifact string, direction string")
    got = [tuple(r) for r in lineage.indirect_leaks(steps, ["test"], ["fit"]).collect()]
    assert got == [("test", "train2", "fit")]
    assert lineage.indirect_leaks(steps.where("stage <> 'peek'"), ["test"], ["fit"]).isEmpty()


def orders(spark, n):
    return spark.range(n).selectExpr("id as k", "cast(id % 7 as string) as a", "if(id % 11 = 0, null, double(id)) as b")


def test_trees_name_exactly_the_changed_rows(spark, tmp_path):
    old = orders(spark, 4000)
    new = old.where("k <> 5").withColumn("a", F.when(F.col("k") == 9, "x").otherwise(F.col("a")))
    new = new.withColumn("b", F.when(F.col("k") == 22, F.lit(0.0)).otherwise(F.col("b"))).unionByName(orders(spark, 4001).where("k = 4000"))
    one, other = hashtree.store_tree(old, "k", str(tmp_path / "a")), hashtree.store_tree(new.repartition(3), ["k"], str(tmp_path / "b"))
    again = hashtree.open_tree(spark, str(tmp_path / "a"))
    got = {tuple(r) for r in hashtree.tree_diff(again, other).collect()}
    assert got == {(5, "removed"), (9, "changed"), (22, "changed"), (4000, "added")}
    buckets = hashtree.differing_buckets(one, other)
    assert 0 < len(buckets) <= 4
    # Only the folders of those buckets are read.
    read = one.rows(buckets)
    assert len({f.rsplit("/", 2)[-2] for f in read.select("_metadata.file_path").distinct().toPandas()["file_path"]}) <= 4
    assert "PartitionFilters: [_folder" in read._jdf.queryExecution().executedPlan().toString() or read.rdd.getNumPartitions() <= 4
    assert hashtree.tree_diff(one, again).isEmpty()


def test_trees_of_repeated_keys_nulls_and_nothing(spark, tmp_path):
    rows = [(1, "x"), (1, "x"), (2, None), (None, "y")]
    old = hashtree.store_tree(spark.createDataFrame(rows, "k int, v string"), "k", str(tmp_path / "a"))
    new = hashtree.store_tree(spark.createDataFrame([(1, "x"), (2, None), (None, "z")], "k int, v string"), "k", str(tmp_path / "b"))
    none = hashtree.store_tree(spark.createDataFrame([], "k int, v string"), "k", str(tmp_path / "c"))
    assert {tuple(r) for r in hashtree.tree_diff(old, new).collect()} == {(1, "changed"), (None, "changed")}
    assert {tuple(r) for r in hashtree.tree_diff(new, none).collect()} == {(1, "removed"), (2, "removed"), (None, "removed")}
    with pytest.raises(DataError):
        hashtree.tree_diff(old, hashtree.store_tree(spark.range(3), "id", str(tmp_path / "d")))
    with pytest.raises(ConfigError):
        hashtree.store_tree(spark.range(3).withColumnRenamed("id", "_hash"), "_hash", str(tmp_path / "e"))


def test_writers_at_the_same_time_lose_and_repeat_nothing(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), "id long, part string", ["part"])
    seen = []

    def write(i):
        rows = spark.range(10 * i, 10 * i + 20).selectExpr("id", "concat('p', id % 3) as part")
        seen.append(log.append_new(rows, checked_key("id long, part string", ["id"])))

    with ThreadPool(8) as pool:
        pool.map(inheritable_thread_target(spark)(write), range(8), chunksize=1)
    assert sorted(r.id for r in log.read().collect()) == list(range(90))
    # A writer that finds all of its rows there makes no commit.
    last = log.version()
    assert set(seen) == set(range(1, last + 1)) and 4 <= last <= 8
    # Every version is whole, and a later one holds all of an earlier one.
    held = [{r.id for r in log.read(v).collect()} for v in range(last + 1)]
    assert all(a < b for a, b in zip(held[:-1], held[1:], strict=True))
    assert log.append_new(log.read(), ["id"]) == last
    assert log.compact() == last + 1 and len(log.folders()) == 1 and log.read().count() == 90
    assert not log._create(last + 1, {"folders": []}) and log.folders(last) != log.folders(last + 1)
    with pytest.raises(ConfigError):
        checked_key("id long", ["x"])


def test_a_folder_without_a_commit_is_not_read(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), "id long")
    log.append(lambda known: spark.range(3).toDF("id"))
    log._write(spark.range(100, 110).toDF("id"))
    assert sorted(r.id for r in log.read().collect()) == [0, 1, 2]


def test_files_are_listed_and_digested_by_tasks(spark, tmp_path):
    rng = random.Random(6)
    files = {"a/x.bin": rng.randbytes(3_000_000), "a/b/c/empty.bin": b"", "a/sp ace é.bin": b"hello", "top.bin": b"1", "a/other.txt": b"no", "a/_hidden.bin": b"no"}
    for name, data in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    got = manifests.large_file_manifest(spark, str(tmp_path), "*.bin").collect()
    want = {n: d for n, d in files.items() if n.endswith(".bin") and "/_" not in n}
    assert len(got) == len(want)
    assert {(r.length, r.md5, r.sha256) for r in got} == {(len(d), hashlib.md5(d).hexdigest(), hashlib.sha256(d).hexdigest()) for d in want.values()}
    whole = manifests.file_manifest(spark, str(tmp_path), "*.bin").collect()
    strip = lambda rows: {(unquote(r.path.replace("file:///", "file:/")), r.sha256) for r in rows}
    assert strip(got) == strip(whole)
    one = manifests.large_file_manifest(spark, f"file://{tmp_path}/top.bin").collect()
    assert [r.length for r in one] == [1]
    with pytest.raises(Exception, match="FileNotFound"):
        manifests.large_file_manifest(spark, str(tmp_path / "none")).collect()


def test_lines_of_samples(spark, tmp_path):
    good = [
        ("up 1", ("up", {}, None, 1.0)),
        ('  a:b{} +Inf 1700000000123  ', ("a:b", {}, 1700000000123, float("inf"))),
        ('m{x="1",y="q\\"\\\\\\n}, {",} -1.5e-3 -5', ("m", {"x": "1", "y": 'q"\\\n}, {'}, -5, -0.0015)),
        ('m { x = "\\\\n" , z="" } .5', ("m", {"x": "\\n", "z": ""}, None, 0.5)),
    ]
    bad = ["m", "m{x=1} 2", 'm{x="1} 2', "1m 2", "m 1 2 3", 'm{x="1",x="2"} 3', "m{,} 1", "m one", "m 1 1.5", "a" * 50_000 + "{"]
    lines = spark.createDataFrame([(x,) for x, _ in good] + [(x,) for x in bad] + [("",), ("# HELP m",), ("  ",), (None,)], "value string")
    rows = parse_samples(lines).withColumn("ms", F.unix_millis("ts")).collect()
    assert sorted((r.metric, sorted(r.labels.items()), r.ms or 0, r.value) for r in rows if r.bad is None) == sorted((m, sorted(v.items()), t or 0, n) for _, (m, v, t, n) in good)
    assert sorted(r.bad for r in rows if r.bad is not None) == sorted(bad)
    assert all(r.metric is None and r.labels is None and r.value is None for r in rows if r.bad is not None)
    samples = parse_samples(lines).where("bad is null").drop("bad")
    again = parse_samples(sample_lines(samples)).drop("bad")
    key = lambda df: sorted(map(str, df.select("metric", F.to_json("labels"), "ts", "value").collect()))
    assert key(again) == key(samples)
    write_sample_text(samples, str(tmp_path / "t"))
    assert key(read_sample_text(spark, str(tmp_path / "t"))) == key(samples)
    streamed = drain(stream_sample_text(spark, str(tmp_path / "t"), maxFilesPerTrigger=1), str(tmp_path / "s"))
    assert key(streamed) == key(samples)


def test_parts_are_closed_where_they_fit_and_doubled_where_not(spark, monkeypatch):
    import random

    rng = random.Random(4)
    # Chains, cycles, trees and loops under random names, and one part that is too large for a task.
    edges = {(f"c{i}-{j}", f"c{i}-{(j + 1) % 12}") for i in range(30) for j in range(12 - i % 2)}
    edges |= {(f"t{rng.randint(0, 40)}", f"t{i}") for i in range(41, 90)} | {("loop", "loop")}
    edges |= {(f"big{i}", f"big{rng.randint(0, 60)}") for i in range(60)} | {(f"big{i}", f"big{i + 1}") for i in range(60)}
    for limit in (1024, 30):
        monkeypatch.setattr(lineage, "PART_NODES", limit)
        df = spark.createDataFrame([*edges, (None, "x"), ("x", None), *list(edges)[:50]], "source string, target string")
        got = [tuple(r) for r in lineage.closure(df.repartition(5)).collect()]
        next_to, want = {}, set()
        for a, b in edges:
            next_to.setdefault(a, set()).add(b)
        for start in next_to:
            waiting, seen = list(next_to[start]), set()
            while waiting:
                node = waiting.pop()
                if node not in seen:
                    seen.add(node)
                    waiting += next_to.get(node, ())
            want |= {(start, node) for node in seen}
        assert len(got) == len(set(got)) and set(got) == want


def test_closing_small_parts_stores_no_pairs(spark):
    seen = []
    chains = spark.range(6000).where("id % 60 < 59").selectExpr("id as source", "id + 1 as target")
    real = lineage.stored
    try:
        lineage.stored = lambda df, purpose: (seen.append(out := real(df, purpose)), out)[1]
        assert lineage.closure(chains).count() == 100 * 59 * 60 // 2
    finally:
        lineage.stored = real
    assert max(t.count() for t in seen) <= 6000
