"""The pipeline, each stage against a plain computation over its own input."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_brute import brute_contamination, brute_lines, brute_links, smallest


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, toxic ones, copies, near copies, a shared passage and benchmark text."""
    rng = random.Random(5)
    vocabulary = [f"w{rng.randint(0, 10**5)}" for _ in range(3000)]
    text = lambda n: "\n".join(" ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(n))
    passage = " ".join(rng.choice(vocabulary) for _ in range(70))
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(25))) for i in range(5)]
    docs, labels = [], []
    for i in range(300):
        body = text(rng.randint(4, 9))
        toxic = i % 6 == 0
        if toxic:
            words = body.split(" ")
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["vile", "foul", "rotten"])
            body = " ".join(words)
        docs.append((i, body))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    base = text(6)
    docs += [(400, base), (401, base), (402, base)]
    one_line = " ".join(rng.choice(vocabulary) for _ in range(45))
    docs += [(410, one_line), (411, one_line + " more")]
    docs += [(420 + i, text(2) + "\n" + passage + "\n" + text(2)) for i in range(3)]
    docs += [(430, text(2) + "\n" + items[2][1].upper() + "\n" + text(1)), (440, None), (441, "")]
    sf = str(tmp_path_factory.mktemp("corpus"))
    frame = spark.createDataFrame([(i, t, "en" if i % 3 else "de", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, docs, items


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_are_as_listed():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "mixing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_equals_a_plain_computation(spark, corpus):
    sf, docs, items = corpus
    table = spark.read.parquet(f"{sf}/documents.parquet")
    stage = {n: lambda d, f=f: f(spark, d, sf) for n, f in corpus_pipeline.STAGES}
    store = corpus_pipeline.stored

    kept = store(stage["toxicity"](table), "a")
    got = rows(kept)
    toxic = {i for i, _ in docs if i < 300 and i % 6 == 0}
    clean = {i for i, _ in docs} - toxic
    assert len(toxic & set(got)) <= 2 and len(clean - set(got)) <= 2
    assert kept.columns == table.columns

    cut = store(stage["line_dedup"](kept), "b")
    want = brute_lines(list(got.items()))
    assert rows(cut) == {i: t for i, t in want.items() if t == got[i] or (t or "").strip()}
    assert 401 not in rows(cut) and 400 in rows(cut) and cut.columns == table.columns

    once = store(stage["ngram_jaccard_join"](cut), "c")
    before = list(rows(cut).items())
    low = smallest([i for i, _ in before], brute_links(before))
    assert rows(once) == {i: t for i, t in before if low[i] == i}
    assert 411 not in rows(once) and 410 in rows(once)

    clean = store(stage["benchmark_decontamination"](once), "d")
    before = list(rows(once).items())
    hit = brute_contamination(before, items)
    assert rows(clean) == {i: t for i, t in before if not hit[i][1]} and 430 not in rows(clean)

    mixed = stage["mixing"](clean)
    assert mixed.columns == [*table.columns, "n_tokens", "rate"]
    assert rows(mixed) == rows(clean) and mixed.where(F.col("rate") < 0).isEmpty()


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_columns_of_any_name_keep_their_values(spark, corpus, name):
    sf, docs, _ = corpus
    names = ["_key", "_at", "_end", "_cut", "_later", "_bits", "_bucket", "_marked", "_key_of", "_gone", "_toxicity", "_mix", "_id", "key", "row", "hash", "Score"]
    table = spark.read.parquet(f"{sf}/documents.parquet")
    extra = [F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names]
    wide = table.select("*", *extra, F.lit("old").alias("rate"), F.lit("old").alias("n_tokens"))
    # Null and repeated ids, and a tie.
    odd = wide.where("doc_id = 410").withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("quite another text"))
    wide = wide.union(wide.where("doc_id in (5, 420)")).union(odd)
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, wide, sf)
    added = {"n_tokens", "rate"} if name == "mixing" else set()
    assert sorted(out.columns) == sorted(wide.columns) if added else out.columns == wide.columns
    got = out.collect()
    plain = {(r.doc_id, r.text) for r in stage(spark, table, sf).collect()}
    assert plain <= {(r.doc_id, r.text) for r in got} and any(r.doc_id is None for r in got)
    for r in got:
        tail = "410" if r.doc_id is None else str(r.doc_id)
        assert all(r[n] == n + tail for n in names)
        assert added or (r.rate, r.n_tokens) == ("old", "old")


def test_run_over_empty_documents(spark, corpus, tmp_path):
    sf, _, _ = corpus
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
