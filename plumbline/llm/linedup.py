"""Removal of passages that occur again, by windows of lines and content-defined chunks.

From each line the fewest lines that hold a passage's words are a window, forwards and
backwards.  A repeated passage of that many words or more is covered by windows that lie
inside it, so each of its lines is found wherever it stands.  Chunks add shorter repeats:
lines are hashed, and a hash that rolls over the last two line hashes decides where a chunk
ends; a line of many words is a chunk of its own.  Windows and chunks whose hashes occur
again are compared by a digest of their bytes.  Their first place, by doc_id and position,
keeps them; elsewhere they go if the repeated lines around them add up to a passage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.filters import key_filter, spots
from plumbline.llm.text import byte_texts, fresh, mixed, small_batches
from plumbline.session import stored

#: A line of so many words is a chunk of its own.
ALONE = 20
#: One in so many short lines ends a chunk.
ENDS = 2
_ODD = 0x9E3779B97F4A7C15
_BACK = pow(_ODD, -1, 1 << 64)


def chunk_lines(text: bytes, alone: int = ALONE) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The lines of a text, the first line of each chunk, and the words and hash of each line."""
    lines = text.split(b"\n")
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines))
    words = np.fromiter((len(x.split()) for x in lines), np.int64, len(lines))
    rolled = hashes * np.uint64(_ODD)
    rolled[1:] += hashes[:-1]
    long = words >= alone
    ends = (rolled >> np.uint64(40)) % np.uint64(ENDS) == 0
    ends |= long
    ends[:-1] |= long[1:]
    ends[-1] = True
    return lines, np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1]), words, hashes


def chunks_of(text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The bytes of each chunk, their hashes, and their words."""
    lines, first, words, _ = chunk_lines(text)
    ends = [*first[1:].tolist(), len(lines)]
    parts = [b"\n".join(lines[a:b]) for a, b in zip(first.tolist(), ends, strict=True)]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    return parts, hashes, np.add.reduceat(words, first)


def spans_of(text: bytes, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First line, line after the last, and hash of each window and chunk; and where lines start in the text."""
    lines, first, words, hashes = chunk_lines(text)
    n = len(lines)
    total = np.concatenate([[0], np.cumsum(words)])
    least = max(min_words, 1)
    ahead = np.searchsorted(total, total[:-1] + least)
    back = np.searchsorted(total, total[1:] - least, "right") - 1
    lead, tail = np.flatnonzero(ahead <= n), np.flatnonzero(back >= 0)
    # Equal windows and chunks once.
    span = np.unique(
        np.concatenate([lead * (n + 1) + ahead[lead], back[tail] * (n + 1) + tail + 1, first * (n + 1) + np.append(first[1:], n)])
    )
    at, end = span // (n + 1), span % (n + 1)
    up, down = np.full(n, _ODD, np.uint64), np.full(n, _BACK, np.uint64)
    up[0] = down[0] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(hashes) * np.cumprod(up, dtype=np.uint64), out=sums[1:])
    rolled = (sums[end] - sums[at]) * np.cumprod(down, dtype=np.uint64)[at]
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lines), np.int64, n) + 1)])
    return at, end, mixed(rolled + (end - at).astype(np.uint64) * np.uint64(_ODD)), starts


def drop_repeated_chunks(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``, and what was taken.

    Adds ``n_chunks, n_removed`` (chunks, and chunks that lost lines) and ``words_removed``,
    all long; a column of such a name is replaced.  Lines are repeated that lie in a chunk, or
    in a passage of ``min_words`` words or more, that occurs earlier, by (doc_id, position).
    A run of neighbouring repeated lines is removed if it has ``min_words`` words or more; a
    passage that overlaps its own first place loses what lies behind that.  The other lines
    keep their order and bytes.  Null and empty texts stay as they are and have no chunks.  A
    null doc_id comes before all others.  Rows that repeat a doc_id with the same text are one
    place: they lose or keep the same.  A hash shared by different bytes removes nothing.
    A text of any length is read whole, by one task.  Other columns pass through unchanged,
    whatever they are called.
    """
    added = ("n_chunks", "n_removed", "words_removed")
    docs = small_batches(docs).drop(*added)
    key = F.xxhash64("doc_id", "text")
    texts = docs.select(F.col("doc_id").cast("string").alias("_id"), key.alias("_key"), F.col("text").alias("_text")).where(
        "_text <> ''"
    )
    ids = dict(docs.dtypes)["doc_id"]
    again = _hashes(texts, min_words).groupBy("hash").count().where("count > 1")
    spans = stored(_spans(texts, again, min_words).withColumn("_id", F.col("_id").cast(ids)), "spans")
    firsts = stored(
        spans.groupBy("digest")
        .agg(F.min(F.struct("_id", "_key", "at", "end")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first._key", "first.at", "first.end")
        .toDF("digest", "first_key", "first_at", "first_end"),
        "repeated",
    )
    own = F.col("first_key") == F.col("_key")
    later = (
        spans.join(firsts, "digest")
        .where(~(own & (F.col("first_at") == F.col("at"))))
        .select("_key", F.struct(F.when(own, F.greatest("at", "first_end")).otherwise(F.col("at")).alias("at"), "end").alias("span"))
        .groupBy("_key")
        .agg(F.collect_set("span").alias("_later"))
        .select("_key", F.col("_later.at").alias("_at"), F.col("_later.end").alias("_end"))
    )
    own_key, at, end, taken = fresh(docs, "_key", "_at", "_end", "_cut")

    @F.pandas_udf("text string, n_chunks long, n_removed long, words_removed long")
    def cut(texts: pd.Series, at: pd.Series, end: pd.Series) -> pd.DataFrame:
        out = [_cut(t, a, b, min_words) for t, a, b in zip(texts, at, end, strict=True)]
        return pd.DataFrame(out, columns=["text", *added])

    joined = docs.select("*", key.alias(own_key)).join(later.toDF(own_key, at, end), own_key, "left")
    return joined.withColumn(taken, cut("text", at, end)).select(
        *[F.col(f"{taken}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        *[F.col(f"{taken}.{c}").alias(c) for c in added],
    )


def _hashes(texts: DataFrame, min_words: int) -> DataFrame:
    """The hash of each window and chunk of each text."""

    def work(batches):
        for batch in batches:
            found = [spans_of(t, min_words)[2] for t in byte_texts(batch.column(0))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["hash"])

    return texts.select("_text").mapInArrow(work, "hash long")


def _spans(texts: DataFrame, again: DataFrame, min_words: int) -> DataFrame:
    """Windows and chunks whose hashes may occur again: their places, and digests of their bytes."""
    marks = texts.sparkSession.sparkContext.broadcast(key_filter(again, F.col("hash")))

    def work(batches):
        marked = marks.value
        for batch in batches:
            rows, digests, at, end = [], [], [], []
            for row, text in enumerate(byte_texts(batch.column(2))):
                first, last, hashes, starts = spans_of(text, min_words)
                some = np.flatnonzero(marked[spots(hashes)])
                a, b = first[some], last[some]
                for i, j in zip(starts[a].tolist(), (starts[b] - 1).tolist(), strict=True):
                    digests.append(hashlib.blake2b(text[i:j], digest_size=16).digest())
                rows.append(np.full(len(some), row))
                at.append(a)
                end.append(b)
            if digests:
                where = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(digests, pa.binary()),
                        batch.column(0).take(where),
                        batch.column(1).take(where),
                        pa.array(np.concatenate(at).astype(np.int32)),
                        pa.array(np.concatenate(end).astype(np.int32)),
                    ],
                    ["digest", "_id", "_key", "at", "end"],
                )

    return texts.mapInArrow(work, "digest binary, _id string, _key long, at int, end int")


def _cut(text: str | None, at, end, min_words: int) -> tuple:
    if not text:
        return text, 0, 0, 0
    lines, first, words, _ = chunk_lines(text.encode())
    if at is None or len(at) == 0:
        # Most texts: no line occurs earlier.
        return text, len(first), 0, 0
    edge = np.zeros(len(lines) + 1, np.int64)
    np.add.at(edge, np.asarray(at, np.int64), 1)
    np.add.at(edge, np.asarray(end, np.int64), -1)
    marked = np.zeros(len(lines) + 2, bool)
    marked[1:-1] = np.cumsum(edge)[:-1] > 0
    edges = np.flatnonzero(marked[1:] != marked[:-1]).reshape(-1, 2)
    keep, gone = np.ones(len(lines), bool), 0
    for a, b in edges.tolist():
        if (n := int(words[a:b].sum())) >= min_words:
            keep[a:b] = False
            gone += n
    removed = int(np.logical_or.reduceat(~keep, first).sum())
    return b"\n".join(x for x, k in zip(lines, keep.tolist(), strict=True) if k).decode(), len(first), removed, gone
