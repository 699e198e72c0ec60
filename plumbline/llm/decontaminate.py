"""Benchmark decontamination with a broadcast hash set of item n-grams, in SQL functions only.

Items and documents are cut into the same normalised words.  The hashes of the items'
windows are joined to the hashes of all document windows; only what hits is looked at
again, word by word.  A window is ``n`` words of an item; an item of fewer words, but not
none, is one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.filters import marked, without_keys
from plumbline.llm.text import fresh
from plumbline.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything in ASCII but digits and small letters separates words (after A-Z is lower-cased).
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before lower-casing.
_GAP, _WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: The item windows are broadcast up to this many (16 bytes each); beyond it they are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000


def words_of(text: Column) -> Column:
    """The normalised words of a text; null has none."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(plain, GAP), lambda w: w != "")


def _windows(words: Column, width: int) -> Column:
    """``pos`` (from 0) and hash of each run of ``width`` words."""
    starts = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - (width - 1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, width)))


def item_windows(items: DataFrame, n: int = 10) -> DataFrame:
    """``item_id, width, hash, window``: the distinct windows of each item, as word arrays."""
    worded = items.select("item_id", words_of(F.col("text")).alias("words")).where("size(words) > 0")
    width = F.least(F.size("words"), F.lit(n))
    starts = F.sequence(F.lit(1), F.size("words") - width + 1)
    return (
        worded.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, width))).alias("window"))
        .distinct()
        .select("item_id", F.size("window").alias("width"), F.xxhash64("window").alias("hash"), "window")
    )


def contamination(docs: DataFrame, items: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """What of the items occurs in the documents.

    Returns two tables keyed by ``_key``, a hash of (doc_id, text): ``spots``, one row per
    distinct word position inside an occurring window, and ``hits``, one row per document and
    item with an occurring window.  Rows that repeat a doc_id and text share a key.  Null and
    wordless texts or items have no windows; a null item_id stands for itself.
    """
    windows = stored(item_windows(items, n), "windows")
    sizes = windows.groupBy("width").agg(F.countDistinct("hash").alias("n")).collect()
    texts = docs.select(doc_key().alias("_key"), F.col("text").cast("string").alias("text"))
    keys = windows.select("hash", "width").distinct()
    if sum(r["n"] for r in sizes) <= BROADCAST_WINDOWS:
        keys = F.broadcast(keys)
    words = texts.select("_key", words_of(F.col("text")).alias("words"))
    # At most n widths, and just one where every item is long.
    found = None
    for width in sorted(r["width"] for r in sizes):
        at = words.select("_key", F.posexplode(_windows(F.col("words"), width)).alias("pos", "hash"))
        at = at.join(keys.where(F.col("width") == width), "hash").select("_key", "pos", "hash", "width")
        found = at if found is None else found.union(at)
    if found is None:
        found = texts.select("_key", F.lit(0).alias("pos"), F.lit(0).cast("long").alias("hash"), F.lit(0).alias("width")).limit(0)
    found = stored(found.distinct(), "found")
    # Verify word by word: the hit documents' words against the items' windows.
    keyed = stored(found.select("_key").distinct(), "keys")
    maybe = marked(texts, F.col("_key"), keyed, F.col("_key")).where("_marked").drop("_marked")
    hit = maybe.join(keyed, "_key", "left_semi").dropDuplicates(["_key"])
    read = found.join(hit.select("_key", words_of(F.col("text")).alias("words")), "_key").select(
        "_key", "pos", "width", "hash", F.slice("words", F.col("pos") + 1, F.col("width")).alias("window")
    )
    distinct = windows.select("hash", "window").distinct()
    sure = stored(read.join(distinct, ["hash", "window"]).select("_key", "pos", "width", "hash"), "sure")
    spots = sure.select(
        "_key", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("width") - 1)).alias("pos")
    ).distinct()
    hits = sure.select("_key", "hash", "width").distinct().join(windows, ["hash", "width"]).select("_key", "item_id").distinct()
    return spots, hits


def doc_key() -> Column:
    return F.xxhash64("doc_id", F.col("text").cast("string"))


def contamination_report(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts the words inside an occurring window, ``n_items`` the items with one;
    the digest is over those item_ids, sorted as strings and joined by commas.
    """
    spots, hits = contamination(docs, items, n)
    counted = spots.groupBy("_key").agg(F.count("*").alias("n_hit"))
    named = hits.groupBy("_key").agg(
        F.count("*").alias("n_items"),
        F.array_join(F.sort_array(F.collect_list(F.coalesce(F.col("item_id").cast("string"), F.lit("")))), ",").alias("names"),
    )
    size = F.size(words_of(F.col("text"))).cast("long")
    return (
        docs.select("doc_id", doc_key().alias("_key"), size.alias("n_words"))
        .join(counted, "_key", "left")
        .join(named, "_key", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, items: DataFrame, n: int = 10, share: float = 0.0) -> DataFrame:
    """``docs`` without the rows of which more than ``share`` of the words are hit."""
    spots, _ = contamination(docs, items, n)
    counted = stored(spots.groupBy(F.col("_key").alias("_hit_key")).agg(F.count("*").alias("_hit")), "counts")
    bad = stored(
        marked(docs.select(doc_key().alias("_hit_key"), "text"), F.col("_hit_key"), counted, F.col("_hit_key"))
        .where("_marked")
        .select("_hit_key", F.size(words_of(F.col("text"))).alias("_n"))
        .join(counted, "_hit_key")
        .where(F.col("_hit") > share * F.col("_n"))
        .select("_hit_key")
        .distinct(),
        "contaminated",
    )
    return without_keys(docs, doc_key(), bad)


def without_spans(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """``docs`` with the hit words taken out of ``text``; what stands between words stays."""
    spots, _ = contamination(docs, items, n)
    # One map per hit document, no longer than its text.
    gone = spots.groupBy(F.col("_key").alias("_hit_key")).agg(
        F.map_from_entries(F.collect_list(F.struct("pos", F.lit(True)))).alias("_gone")
    )
    mine, lost = fresh(docs, "_hit_key", "_gone")
    text = F.col("text").cast("string")
    # Each piece is one word with the gap before it; the last gap follows.
    pieces = F.regexp_extract_all(text, F.lit(f"{_GAP}*{_WORD}+"), F.lit(0))
    kept = F.transform(
        pieces,
        lambda piece, i: F.when(
            F.map_contains_key(lost, i), F.regexp_replace(piece, F.lit(f"{_WORD}+$"), F.lit(""))
        ).otherwise(piece),
    )
    tail = F.regexp_extract(text, f"({_GAP}*)\\z", 1)
    return (
        docs.select("*", doc_key().alias(mine))
        .join(gone.toDF(mine, lost), mine, "left")
        .withColumn("text", F.when(F.col(lost).isNull(), text).otherwise(F.concat(F.array_join(kept, ""), tail)))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
