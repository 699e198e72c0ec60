"""Secret scanning with a random forest that removes false positives, in SQL functions and ML alone.

Candidates are long runs of value characters that hold a digit or a run of capitals.  Each is described by its length, its character
transitions (how likely they are in the corpus's own common words), how much of it common words cover, its
path and its neighbouring words.  A forest learnt from labelled findings scores them.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import stored

BLANK = r"[\x20\x09-\x0D]+"
# Shapes of issued keys and of harmless long words, and names around values.
ISSUED = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|xox[baprs]-[A-Za-z0-9-]{10,})$"
ASSIGNED = r"^(?:[0-9a-f]{16,}|[A-Za-z0-9+/_-]{20,})$"
HARMLESS = (
    r"(?i)^(?:[^@]+@[^@]+|[0-9]{13,19}|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}|[a-z]+://.*|[0-9.]+|.*(?:example|placeholder|changeme).*)$"
)
CREDENTIAL = r"(?i)password|passwd|secret|token|api[_-]?key|credential"
HARMLESS_PATH = r"(?i)test|example|sample|mock|fixture|doc"
# End of fixed values.
# Value characters; what stands between a name and its value, or ends the scheme of a URL.
_SIGNS = "A-Za-z0-9+/_.@-"
_RUN = rf"[{_SIGNS}]{{16,}}"
_JOINS = r"^[^=:,;&?]*[=:][^,;&?]*$"
#: Words of the dictionary at most; it and the table of its letter pairs are broadcast.
DICTIONARY = 4096
#: Labelled findings of each label that the forest learns from at most.
LEARN = 4000
FEATURES = [
    "size", "digits", "capitals", "signs", "letter_digit", "case_changes", "distinct", "transitions", "covered",
    "path_depth", "path_harmless", "named", "name_before", "assigned", "quoted", "next_size",
]


def dictionary(docs: DataFrame, most: int = DICTIONARY) -> DataFrame:
    """``word, n``: the most frequent words of letters (3 to 12, in lower case) of all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.col("text").cast("string")), BLANK)).alias("word"))
    return (
        words.where(F.col("word").rlike(r"^[a-z]{3,12}$"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(most)
    )


def candidates(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, pos, path, value, name, before, after, quoted`` for each candidate of each whole text.

    Candidates are the longest runs of value characters, 16 or more, whatever stands beside them.
    Dots and @ at the ends of a run are left off; a run with other signs at its ends is a candidate
    with and without them.  Sign-in data and host of a URL are runs of their own.  ``pos`` counts
    the words of the text from 0; the candidates of one word share it.  Null and empty texts have none.
    """
    words = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), BLANK)
    place = F.lit("") if path is None else F.coalesce(F.col(path).cast("string"), F.lit(""))
    long = lambda i: (F.length(F.get("words", i)) >= 16) & F.get("words", i).rlike("[0-9]|[A-Z]{16}") & F.get("words", i).rlike(_RUN)
    near = lambda i: F.coalesce(F.get("words", i), F.lit(""))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), long)
    found = docs.select("doc_id", place.alias("path"), words.alias("words")).select(
        "doc_id",
        "path",
        F.explode(
            F.transform(
                at,
                lambda i: F.struct(
                    i.alias("pos"),
                    F.get("words", i).alias("raw"),
                    F.concat_ws(" ", near(i - 2), near(i - 1)).alias("before"),
                    near(i + 1).alias("after"),
                ),
            )
        ).alias("x"),
    )
    # Runs and the marks around them, both in order; the marks before run i are the i-th.
    cut = found.select(
        "doc_id",
        "path",
        "x.*",
        F.filter(F.split("x.raw", rf"[^{_SIGNS}]+"), lambda r: r != "").alias("runs"),
        F.split("x.raw", rf"[{_SIGNS}]+").alias("marks"),
    )
    run = lambda i: F.coalesce(F.get("runs", i), F.lit(""))
    mark = lambda i: F.coalesce(F.get("marks", i), F.lit(""))
    rows = cut.select(
        "doc_id", "pos", "path", "before", "after", "runs", "marks", F.posexplode("runs").alias("i", "run")
    ).where(F.length("run") >= 16)
    i = F.col("i")
    signed_in = F.col("run").contains("@") & (
        (F.col("run").startswith("//") & mark(i).startswith(":")) | (run(i - 1).startswith("//") & mark(i).startswith(":"))
    )
    pieces = F.when(signed_in, F.split("run", "@(?=[^@]*$)")).otherwise(F.array("run"))
    ends = F.transform(pieces, lambda p: F.regexp_replace(p, "^[.@]+|[.@]+$", ""))
    values = F.array_distinct(
        F.flatten(F.transform(ends, lambda p: F.array(p, F.regexp_replace(p, "^[+/_.@-]+|[+/_.@-]+$", ""))))
    )
    return (
        rows.withColumn("name", F.when((i > 0) & mark(i).rlike(_JOINS), run(i - 1)).otherwise(""))
        .withColumn("quoted", F.concat(mark(i), mark(i + 1)).rlike("[\"'`]"))
        .withColumn("value", F.explode(values))
        .where((F.length("value") >= 16) & F.col("value").rlike("[0-9]|[A-Z]{16}"))
        .select("doc_id", "pos", "path", "value", "name", "before", "after", "quoted")
    )


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with one column of numbers for each of ``FEATURES``."""
    value, low = F.col("value"), F.lower("value")
    count = lambda pattern: F.regexp_count(value, F.lit(pattern)).cast("double")
    flag = lambda condition: condition.cast("double")
    words = stored(words, "dictionary")
    pairs = words.select("n", F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))")).alias("pair"))
    seen = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    # Log-share of each of the 26 x 26 pairs; the rest counts as one occurrence.
    total = seen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"] + 1
    likely = F.broadcast(seen.select("pair", F.log(F.col("n") / float(total)).alias("likely")))
    texts = stored(found.select("value").distinct(), "values")
    moves = (
        texts.select("value", F.explode(F.expr("transform(sequence(1, length(value) - 1), i -> substring(lower(value), i, 2))")).alias("pair"))
        .join(likely, "pair", "left")
        .groupBy("value")
        .agg(F.avg(F.coalesce("likely", F.log(F.lit(1.0 / total)))).alias("transitions"))
    )
    spans = F.expr(
        "flatten(transform(sequence(1, length(value) - 2), i -> transform(sequence(3, least(12, length(value) - i + 1)),"
        " n -> struct(i as at, n as n, substring(lower(value), i, n) as word))))"
    )
    covered = (
        texts.select("value", F.inline(spans))
        .join(F.broadcast(words.select("word")), "word")
        .select("value", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("at"))
        .distinct()
        .groupBy("value")
        .agg(F.count("*").alias("spots"))
    )
    near = F.concat_ws(" ", "name", "before")
    out = (
        found.join(moves, "value", "left")
        .join(covered, "value", "left")
        .withColumn("size", F.length(value).cast("double"))
        .withColumn("digits", count("[0-9]") / F.col("size"))
        .withColumn("capitals", count("[A-Z]") / F.col("size"))
        .withColumn("signs", count("[^A-Za-z0-9]") / F.col("size"))
        .withColumn("letter_digit", count("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])") / F.col("size"))
        .withColumn("case_changes", count("(?<=[a-z])(?=[A-Z])") / F.col("size"))
        .withColumn("distinct", (F.size(F.array_distinct(F.split(low, ""))) / F.col("size")).cast("double"))
        .withColumn("covered", F.coalesce(F.col("spots") / F.col("size"), F.lit(0.0)))
        .withColumn("path_depth", F.regexp_count("path", F.lit("/")).cast("double"))
        .withColumn("path_harmless", flag(F.col("path").rlike(HARMLESS_PATH)))
        .withColumn("named", flag(F.col("name") != ""))
        .withColumn("name_before", flag(near.rlike(CREDENTIAL)))
        .withColumn("assigned", flag((F.col("name") != "") | F.col("before").rlike("[=:]$")))
        .withColumn("quoted", flag(F.col("quoted")))
        .withColumn("next_size", F.least(F.length("after"), F.lit(40)).cast("double"))
        .drop("spots")
    )
    return out.withColumn("transitions", F.coalesce("transitions", F.lit(0.0)))


def known_label() -> Column:
    """1 for the shape of an issued key or a value assigned to a credential, 0 for a harmless shape, else null."""
    value, near = F.col("value"), F.concat_ws(" ", "name", "before")
    held = near.rlike(CREDENTIAL) & ((F.col("name") != "") | F.col("before").rlike("[=:]$"))
    return F.when(value.rlike(HARMLESS), 0).when(value.rlike(ISSUED) | (held & value.rlike(ASSIGNED)), 1)


def learn_forest(findings: DataFrame, trees: int = 40, depth: int = 8, seed: int = 3):
    """A forest learnt from ``findings(value, label, ...FEATURES)``, or the rate of label 1.

    Of each label the ``LEARN`` findings of smallest value hash are used, equal values once.
    The rate is returned where there is only one label, and 0 where there is none.
    """
    once = stored(findings.where("label is not null").dropDuplicates(["value"]).select("value", "label", *FEATURES), "labelled")
    have = {r["label"]: r["n"] for r in once.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(have) < 2:
        return float(next(iter(have), 0))
    some = None
    for label in sorted(have):
        part = once.where(F.col("label") == label).orderBy(F.xxhash64("value"), "value").limit(LEARN)
        some = part if some is None else some.union(part)
    # Laid out by key, so that equal findings give an equal forest.
    rows = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(
        stored(some.withColumn("label", F.col("label").cast("double")), "learn").repartition(8, "value").sortWithinPartitions("value")
    )
    return RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed).fit(rows)


def scored(findings: DataFrame, forest) -> DataFrame:
    """``findings`` with a ``score``: the forest's share of votes for a secret."""
    if isinstance(forest, float):
        return findings.withColumn("score", F.lit(forest))
    out = forest.transform(VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(findings).withColumnRenamed("_x", "x"))
    return out.withColumn("score", F.get(vector_to_array("probability"), 1)).drop("x", "rawPrediction", "probability", "prediction")


def scan_secrets(docs: DataFrame, path: str | None = None, label: Column | None = None) -> DataFrame:
    """``doc_id, pos, value_sha256, score, secret`` for each candidate of ``docs(doc_id, text, path)``.

    ``label`` tells the labelled findings (0, 1, null) the forest learns from, by default
    ``known_label()``.  The value itself is not in the result.  A null doc_id or path is kept
    as it is; repeated rows give repeated findings; columns of other names are ignored.
    Texts without candidates have no rows.
    """
    docs = docs.select("doc_id", "text", *([path] if path else []))
    found = stored(candidates(docs, path), "candidates")
    rows = stored(described(found, dictionary(docs)).withColumn("label", known_label() if label is None else label), "findings")
    return scored(rows, learn_forest(rows)).select(
        "doc_id",
        F.col("pos").cast("long").alias("pos"),
        F.sha2("value", 256).alias("value_sha256"),
        "score",
        (F.col("score") >= 0.5).alias("secret"),
    )
