"""Words and hashes of whole texts, a batch at a time, inside Spark's tasks.

Words are split on bytes, so only A-Z is lower-cased and only ASCII blanks separate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are hashed together; a longer text is hashed alone.
TOGETHER = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in whose session workers now get at most 500 rows and 4 MB at a time.

    Texts are whole, so a batch of the default size may hold very much.
    """
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to be no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a null key has remainder -1."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(n)), F.lit(-1))


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a finalising permutation)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sorted_distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


# A random value for each byte, the same for A-Z as for a-z; blanks are marked apart.
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_VALUES[65:91] = _VALUES[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BACK = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_runs(column: pa.Array):
    """``(text, at, to, hashes, start)`` for runs of rows of a text column.

    ``text`` are the bytes of the run; ``at``, ``to`` and ``hashes`` tell where its words
    start and end, and their 64-bit hashes.  ``start[i]`` is the first word of the i-th row of
    the run (with one more entry for the end).  Hashing is a prefix sum over bytes, so its
    cost is that of a few numpy passes.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        stop = max(int(np.searchsorted(ends, ends[row] + TOGETHER, "right")) - 1, row + 1)
        text = data[ends[row] : ends[stop]]
        if not len(text):
            none = np.zeros(0, np.int64)
            yield text, none, none, np.zeros(0, np.uint64), np.zeros(stop - row + 1, np.int64)
            row = stop
            continue
        first = ends[row:stop] - ends[row]
        at, to, hashes = located_words(text, first)
        yield text, at, to, hashes, np.searchsorted(at, np.append(first, len(text)))
        row = stop


def located_words(text: np.ndarray, first=(0,)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word in bytes; texts start at ``first``, where no word goes on."""
    blank = _BLANK[text]
    fresh = np.zeros(len(text) + 1, bool)
    fresh[first] = True
    at = np.flatnonzero(~blank & (np.append(True, blank[:-1]) | fresh[:-1]))
    to = np.flatnonzero(~blank & (np.append(blank[1:], True) | fresh[1:])) + 1
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_VALUES[text] * _powers(_ODD, len(text)), out=total[1:])
    hashes = (total[to] - total[at]) * _powers(_BACK, len(text))[at]
    return at, to, mixed(hashes + (to - at).astype(np.uint64) * _ODD)


def shingle_sets(column: pa.Array, k: int):
    """Sorted distinct hashes of the ``k``-word shingles of each text, in the order of the rows.

    A text of fewer words is one shingle; one without words has none.
    """
    for _, _, _, words, start in word_runs(column):
        rolled = np.full(max(len(words) - k + 1, 0), k, np.uint64)
        for i in range(k):
            rolled = rolled * _ODD + words[i : len(words) - k + 1 + i] if len(rolled) else rolled
        rolled = mixed(rolled)
        for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True):
            if b - a >= k:
                yield sorted_distinct(rolled[a : b - k + 1])
            elif a == b:
                yield np.zeros(0, np.uint64)
            else:
                short = np.full(1, b - a, np.uint64)
                for i in range(a, b):
                    short = short * _ODD + words[i]
                yield mixed(short)
