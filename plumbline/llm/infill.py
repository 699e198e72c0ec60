"""Fill-in-the-middle transformation by secondary-sort assembly.

A text is cut into units (runs of ASCII letters, or single other code points) and by two
hashes of its id into prefix, middle and suffix.  Chunks of units travel as pieces, keyed by
document and output position; ``repartitionAndSortWithinPartitions`` brings each document's
pieces together in output order, where they stream into a digest (or a text) one at a time.
The assembled output alone is then parsed at its marks and its pieces are sorted again by
their place in the original, which restores it.  The second sort keeps the first one's
partitioning, so whole texts are shuffled once.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Units of a piece, and bytes of one at most (a single unit can be long).
CHUNK, PIECE = 4096, 1 << 16
PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK = b"<P>", b"<S>", b"<M>"
_MARKS = (PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: The order in which a form writes the parts (0 prefix, 1 middle, 2 suffix).
_ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
_PART_MARK = {0: PREFIX_MARK, 1: MIDDLE_MARK, 2: SUFFIX_MARK}
#: Bytes of text that a partition sorts, at most on average.
SORTED = 32 << 20
#: Places of a part in the restored order: a part never has so many pieces.
_PART = 1 << 40


def unit_starts(text: bytes) -> np.ndarray:
    """Where the units of a UTF-8 text start."""
    raw = np.frombuffer(text, np.uint8)
    letter = _LETTER[raw]
    inside = np.append(False, letter[:-1]) & letter
    return np.flatnonzero(((raw & 0xC0) != 0x80) & ~inside[: len(raw)])


def _code_points(text: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def plan_cuts(doc_id, text: bytes, plain_from: int = 90, spm_below: int = 20):
    """``n, form, first, second, starts``: units, form, and the byte offsets of the two cuts."""
    starts = unit_starts(text)
    n = len(starts)
    hexed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[i : i + 8], 16) for i in range(0, 32, 8))
    if not n or h3 % 100 >= plain_from or any(m in text for m in _MARKS):
        return n, "plain", None, None, starts
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    ends = np.append(starts, len(text))
    return n, "spm" if h4 % 100 < spm_below else "psm", int(ends[low]), int(ends[high]), starts


def _pieces(text: bytes, starts: np.ndarray, a: int, b: int) -> Iterator[bytes]:
    """``text[a:b]`` in chunks of units."""
    inside = starts[np.searchsorted(starts, a) : np.searchsorted(starts, b)]
    edges = [*inside[::CHUNK].tolist(), b]
    for low, high in itertools.pairwise(edges):
        for at in range(low, high, PIECE):
            yield text[at : min(at + PIECE, high)]


def _emitted(rows: Iterable) -> Iterator[tuple]:
    """The header and the pieces of each row, keyed by document, row and output position."""
    for doc_id, text, row in rows:
        text = bytes(text or b"")
        n, form, first, second, starts = plan_cuts(doc_id, text)
        name = f"{doc_id}".encode() + xxhash.xxh3_128_digest(text)
        if form == "plain":
            sizes, out = (None, None), _pieces(text, starts, 0, len(text))
        else:
            spans = {0: (0, first), 1: (first, second), 2: (second, len(text))}
            sizes = _code_points(text[:first]), _code_points(text[first:second])
            out = itertools.chain.from_iterable(
                itertools.chain((_PART_MARK[p],), _pieces(text, starts, *spans[p])) for p in _ORDERS[form]
            )
        yield (name, row, 0), (doc_id, n, form, *sizes)
        for place, piece in enumerate(out, 1):
            yield (name, row, place), piece


def _deal(key: tuple) -> int:
    """The partition of a document; repeated rows are dealt apart."""
    return zlib.crc32(key[0] + key[1].to_bytes(8, "little"))


def _documents(records: Iterable[tuple]) -> Iterator[tuple[tuple, Iterator]]:
    """Sorted records as ``(key, values)`` of one document after the other."""
    for key, group in itertools.groupby(records, key=lambda r: r[0][:2]):
        yield key, (value for _, value in group)


class _Digest:
    """Takes pieces; holds a digest only."""

    def __init__(self):
        self.state = hashlib.sha256()
        self.take = self.state.update

    def result(self) -> str:
        return self.state.hexdigest()


class _Text:
    """Takes pieces; holds the text."""

    def __init__(self):
        self.parts: list[bytes] = []
        self.take = self.parts.append

    def result(self) -> str:
        return b"".join(self.parts).decode(errors="replace")


def parsed(form: str, pieces: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """``(part, bytes)`` of an output given piece by piece, told by its form and marks alone.

    A mark may lie across pieces, so two bytes are held back.
    """
    if form == "plain":
        yield from ((0, piece) for piece in pieces)
        return
    waiting, part, held = list(_ORDERS[form]), None, b""
    for piece in pieces:
        held += piece
        while waiting and (at := held.find(_PART_MARK[waiting[0]])) >= 0:
            if at:
                yield part, held[:at]
            part, held = waiting.pop(0), held[at + 3 :]
        keep = 2 if waiting else 0
        if len(held) > keep:
            yield part, held[: len(held) - keep]
            held = held[len(held) - keep :]
    if held:
        yield part, held


def assembled(docs: DataFrame, partitions: int | None = None) -> RDD:
    """``((document, row, position), piece)`` in output order, a document in one partition.

    Position 0 holds ``(doc_id, n, form, prefix_chars, middle_chars)``; the pieces that follow make the output.
    There are as many partitions as the session shuffles to, and more where texts would not fit their sort.
    """
    kept = docs.select(
        "doc_id", F.col("text").cast("string").cast("binary").alias("text"), F.monotonically_increasing_id()
    )
    parts = partitions
    if not parts:
        size = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SORTED))
    return kept.rdd.mapPartitions(_emitted).repartitionAndSortWithinPartitions(parts, _deal)


def _output_and_restored(docs: DataFrame, sink: type, suffix: str, partitions: int | None) -> DataFrame:
    def outputs(records):
        for key, values in _documents(records):
            head, out, seen = next(values), sink(), 0

            def taken(values=values, out=out):
                for piece in values:
                    out.take(piece)
                    yield piece

            for part, piece in parsed(head[2], taken()):
                seen += 1
                yield (*key, 1 + part * _PART + seen), piece
            yield (*key, 0), (*head, out.result())

    def restored(records):
        for _, values in _documents(records):
            head, text = next(values), sink()
            for piece in values:
                text.take(piece)
            yield (*head, text.result())

    ordered = assembled(docs, partitions)
    again = ordered.mapPartitions(outputs, True).repartitionAndSortWithinPartitions(ordered.getNumPartitions(), _deal)
    kind = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField(f"output{suffix}", T.StringType()),
            T.StructField(f"restored{suffix}", T.StringType()),
        ]
    )
    return docs.sparkSession.createDataFrame(again.mapPartitions(restored), kind, verifySchema=False)


def fim_digests(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Units, form, sizes and the SHA-256 of output and restored text for each row of ``docs(doc_id, text)``.

    A null text is empty; empty texts and such as hold a mark stay plain.  A null doc_id is
    hashed as no digits.  Repeated rows give repeated results.  Texts of any length stream in
    pieces of ``PIECE`` bytes at most, so a long one costs memory only while it is cut.  Other
    columns are ignored, whatever their names.  An empty table gives no rows.  ``docs`` must
    be a table or stored: rows are told apart by their places in it.
    """
    return _output_and_restored(docs, _Digest, "_sha256", partitions)


def fim_texts(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """The same with the texts themselves: ``output`` to train on, ``restored`` to compare."""
    return _output_and_restored(docs, _Text, "", partitions)
