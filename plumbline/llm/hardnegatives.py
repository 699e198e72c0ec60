"""Hard negatives by threshold joins of anchors with all rows, exact in integers.

Anchors go out in chunks of bounded size; every task searches its rows for all anchors of a
chunk.  A block of rows is indexed by dimension: postings of the leading dimensions are
accumulated for all anchors at once, the trailing dimensions of a row stay out of the index
where the norms of what remains show that they alone cannot reach any threshold.  Pairs
whose partial score and remaining norms stay below the threshold are pruned, the others are
finished exactly.  Thresholds start high and are lowered, round by round, for the anchors
whose windows did not fill; within a task they rise again as windows fill.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.text import small_batches
from plumbline.session import shared_dir, stored

#: Dimensions of a step of accumulation, rows of a block, and numbers of a chunk of anchors (32 MB).
STEP, BLOCK, CHUNK_NUMBERS = 8, 4096, 1 << 22
#: Anchors of a chunk at most.
CHUNK = 1024
#: The largest sum that floats hold exactly.
EXACT = float(1 << 53)
#: Shares of an anchor's own product from which positives are sought, before all rows are.
POSITIVE_LADDER = (0.5,)
#: Bounds of a long, and of what scores are compared as.
_LOW, _HIGH, _MOST = -(1 << 63), (1 << 63) - 1, 10**38 - 1


@dataclass
class Windows:
    """What is sought: for each window its anchor, its bounds (numbers of any size), and how many rows fill it."""

    anchor: np.ndarray
    low: list
    high: list
    same: bool
    k: int


class _Found:
    """The best rows of each window within a task."""

    def __init__(self, windows: Windows):
        self.windows = windows
        self.ids = [np.zeros(0, np.int64)] * len(windows.anchor)
        self.scores: list = [np.zeros(0)] * len(windows.anchor)
        self.floor = list(windows.low)

    def add(self, w: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids[w], ids]), np.concatenate([self.scores[w], scores])
        # Two stable sorts, because exact scores may be objects.
        best = np.argsort(ids, kind="stable")
        best = best[np.argsort(-scores[best], kind="stable")][: self.windows.k]
        self.ids[w], self.scores[w] = ids[best], scores[best]
        if len(best) == self.windows.k:
            self.floor[w] = max(self.floor[w], scores[best[-1]])


def _lengths(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and flat numbers of a list column without nulls."""
    sizes = np.diff(column.offsets.to_numpy())
    return sizes, column.flatten().to_numpy(zero_copy_only=False)


class Searcher:
    """All anchors of a chunk that have the same number of dimensions, against blocks of rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, windows: Windows, own: np.ndarray):
        self.ids, self.labels, self.whole = ids, labels, vectors
        self.windows, self.own = windows, own
        self.most = float(np.abs(vectors.astype(float)).max(initial=0))
        # Dimensions in which anchors are large come first.
        self.order = np.argsort(-np.abs(vectors.astype(float)).sum(0), kind="stable")
        self.vectors = np.ascontiguousarray(vectors[:, self.order].astype(float))
        self.rest = _remaining(self.vectors)

    def scores(self, rows: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(scores, alive, places)``: the exact scores of pairs that are alive, columns by ``places`` in the block.

        All other pairs, and all of the rows not placed, lie below their anchor's ``floor``.
        """
        dims = rows.shape[1]
        if dims * self.most * float(np.abs(rows.astype(float)).max(initial=0)) >= EXACT:
            exact = self.whole.astype(object) @ rows.astype(object).T
            return exact, np.ones(exact.shape, bool), np.arange(len(rows))
        rows = rows[:, self.order].astype(float)
        rest = _remaining(rows)
        steps = rest.shape[1] - 1
        # The index ends where no anchor's remaining norm can lift a row's to any threshold.
        least = floor.min(initial=np.inf)
        reach = rest * self.rest.max(0, initial=0.0) * (1 + 1e-9)
        depth = np.where(reach < least, np.arange(steps + 1), steps).min(1)
        places = np.argsort(-depth, kind="stable")
        rows, rest, depth = rows[places], rest[places], depth[places]
        part = np.zeros((len(self.ids), len(rows)))
        for s in range(steps):
            m = int(np.searchsorted(-depth, -s, "left"))
            cut = slice(s * STEP, (s + 1) * STEP)
            part[:, :m] += self.vectors[:, cut] @ rows[:m, cut].T
            if s == steps // 2:
                # Half way, rows that no anchor can still reach leave the accumulation.
                done = np.minimum(depth, s + 1)
                keep = np.flatnonzero((self._bound(part, rest, done) >= floor[:, None]).any(0))
                if len(keep) < len(rows):
                    rows, rest, depth, places, part = rows[keep], rest[keep], depth[keep], places[keep], part[:, keep]
        alive = self._bound(part, rest, depth) >= floor[:, None]
        for d in np.unique(depth[depth < steps]).tolist():
            at = np.flatnonzero((depth == d) & alive.any(0))
            part[:, at] += self.vectors[:, d * STEP :] @ rows[at, d * STEP :].T
        return part, alive, places

    def _bound(self, part: np.ndarray, rest: np.ndarray, done: np.ndarray) -> np.ndarray:
        """What scores can reach at most, with ``done`` steps of each row accumulated."""
        return part + self.rest[:, done] * rest[np.arange(len(rest)), done] * (1 + 1e-9) + 1e-6

    def meet(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, found: _Found) -> None:
        """Add what a block of rows gives to the windows."""
        windows = self.windows
        floors = np.full(len(self.ids), np.inf)
        np.minimum.at(floors, windows.anchor[self.own], np.array([float(found.floor[w]) for w in self.own.tolist()]))
        scores, alive, places = self.scores(rows, floors)
        ids, labels = ids[places], labels[places]
        for w in self.own.tolist():
            a = windows.anchor[w]
            s = scores[a]
            at = np.flatnonzero(alive[a] & (s >= found.floor[w]).astype(bool) & (s <= windows.high[w]).astype(bool))
            at = at[(ids[at] != self.ids[a]) & ((labels[at] == self.labels[a]) == windows.same)]
            if len(at):
                found.add(w, ids[at], s[at])


def _remaining(x: np.ndarray) -> np.ndarray:
    """Norms of what lies beyond each step of dimensions (first: of all, last: 0)."""
    steps = -(-x.shape[1] // STEP)
    squares = np.zeros((len(x), steps + 1))
    for s in range(steps - 1, -1, -1):
        part = x[:, s * STEP : (s + 1) * STEP]
        squares[:, s] = squares[:, s + 1] + (part * part).sum(1)
    return np.sqrt(squares)


def _search(rows: DataFrame, anchors: list, windows: Windows) -> DataFrame:
    """``window, vec_id, score, place`` of the rows that fill the windows of a chunk of anchors."""
    shared = rows.sparkSession.sparkContext.broadcast(
        (np.array([a["vec_id"] for a in anchors], np.int64), np.array([a["label"] for a in anchors], np.int64),
         [np.array(a["vector"], np.int64) for a in anchors], windows)
    )

    def work(batches):
        a_ids, a_labels, a_vectors, windows = shared.value
        sizes = np.array([len(v) for v in a_vectors])
        place = np.zeros(len(a_ids), np.int64)
        searchers = {}
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            place[at] = np.arange(len(at))
            own = np.flatnonzero(np.isin(windows.anchor, at))
            local = Windows(place[windows.anchor], windows.low, windows.high, windows.same, windows.k)
            block = np.array([a_vectors[i] for i in at], np.int64).reshape(len(at), size)
            searchers[size] = Searcher(a_ids[at], a_labels[at], block, local, own)
        found = _Found(windows)
        held: dict[int, list] = {size: [] for size in searchers}

        def flush(size):
            if held[size]:
                searchers[size].meet(*[np.concatenate([h[i] for h in held[size]]) for i in range(3)], found)
                held[size] = []

        for batch in batches:
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lengths, flat = _lengths(batch.column(2))
            starts = np.append(0, np.cumsum(lengths))
            for size in set(np.unique(lengths).tolist()) & set(searchers):
                at = np.flatnonzero(lengths == size)
                numbers = flat[starts[at][:, None] + np.arange(size)[None, :]].reshape(len(at), size)
                held[size].append((ids[at], labels[at], numbers))
                if sum(len(h[0]) for h in held[size]) >= BLOCK:
                    flush(size)
        for size in searchers:
            flush(size)
        counts = np.array([len(i) for i in found.ids])
        if counts.sum():
            scores = [Decimal(min(max(int(s), -_MOST), _MOST)) for part in found.scores for s in part]
            columns = [pa.array(np.repeat(np.arange(len(counts)), counts)), pa.array(np.concatenate(found.ids)), pa.array(scores, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, ["window", "vec_id", "score"])

    best = Window.partitionBy("window").orderBy(F.desc("score"), "vec_id")
    found = rows.select("vec_id", "label", "vector").mapInArrow(work, "window long, vec_id long, score decimal(38,0)")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= windows.k)


def _positives(rows: DataFrame, anchors: list, k: int) -> list[tuple[int, int, int]]:
    """``anchor, vec_id, score`` of the first ``k`` other rows of each anchor's label, anchors by place."""
    own = [float(sum(v * v for v in a["vector"])) for a in anchors]
    todo, out = np.arange(len(anchors)), []
    for share in (*POSITIVE_LADDER, None):
        low = [-math.inf if share is None else share * own[a] for a in todo.tolist()]
        windows = Windows(todo, low, [math.inf] * len(todo), True, k)
        found: dict[int, list] = {}
        for r in _search(rows, anchors, windows).collect():
            found.setdefault(int(todo[r["window"]]), []).append((r["place"], r["vec_id"], int(r["score"])))
        for a, best in found.items():
            if share is None or len(best) == k:
                out += [(a, i, s) for _, i, s in sorted(best)]
        todo = np.array([a for a in todo.tolist() if len(found.get(a, ())) < k], np.int64)
        if share is None or not len(todo):
            return out
    return out


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows(vec_id long, label, vector array<long>)`` are compared by inner product, higher
    first, ties by smaller vec_id.  An anchor's positives are the first rows of its label.
    Its negatives for a positive are the first rows of another label whose score lies between
    the two percentages of the positive's score.  All rows are searched, and results do not
    depend on chunks, blocks or layout.

    Rows with a null in any of the three columns take no part, nor do vectors with a null
    component.  Only vectors of equal length meet; empty ones have score 0.  A row with the
    anchor's own vec_id is no other row.  Repeated rows are rows of their own.  Scores
    beyond a long are compared exactly, up to 38 digits, and given as the nearest long.  Further columns
    are ignored, whatever their names.  Empty tables and lonely labels give no rows.
    """
    spark = small_batches(rows).sparkSession
    whole = F.expr("vec_id is not null and label is not null and vector is not null and forall(vector, x -> x is not null)")
    kept = stored(
        rows.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.col("vector").cast("array<long>").alias("vector"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        ).where(whole),
        "vectors",
    )
    of_anchor = F.when(F.col("is_anchor"), F.size("vector"))
    chosen = kept.agg(F.count("*").alias("rows"), F.count(of_anchor).alias("n"), F.max(of_anchor).alias("dims")).first()
    # A task that has less than a block of rows costs more to set up than to run.
    kept = kept.coalesce(max(spark.sparkContext.defaultParallelism, math.ceil(chosen["rows"] / BLOCK)))
    path = shared_dir(spark, "negatives")
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], kind).write.parquet(path)
    if chosen["n"]:
        size = max(1, min(CHUNK, CHUNK_NUMBERS // max(chosen["dims"], 1)))
        # Chunks are numbered in few partitions, so that most are full, and stored with their numbers.
        parts = max(1, math.ceil(chosen["n"] / (64 * size)))
        numbered = kept.where("is_anchor").repartition(parts, "vec_id").sortWithinPartitions("vec_id")
        at = F.monotonically_increasing_id()
        chunk = F.shiftright(at, 33) * (1 << 33) + F.floor(at.bitwiseAND(F.lit((1 << 33) - 1)) / size)
        anchors = stored(numbered.select("vec_id", "label", "vector", chunk.alias("chunk")), "anchors")
        for (number,) in sorted(anchors.select("chunk").distinct().collect()):
            some = anchors.where(F.col("chunk") == number).drop("chunk").orderBy("vec_id", "label", "vector").collect()
            _mine(kept, some, _positives(kept, some, positives), negatives, low_percent, high_percent, path)
    return spark.read.schema(kind).parquet(path)


def _mine(rows: DataFrame, anchors: list, positives: list, k: int, low_percent: int, high_percent: int, path: str) -> None:
    """Append the negatives of a chunk of anchors, lowering the threshold until windows fill."""
    scores = [s for _, _, s in positives]
    low = [-(-low_percent * s // 100) for s in scores]
    high = [high_percent * s // 100 for s in scores]
    todo = [i for i in range(len(positives)) if low[i] <= high[i]]
    for last in (False, True):
        if not todo:
            return
        start = [low[i] if last else max(low[i], (low[i] + high[i] + 1) // 2) for i in todo]
        at = np.array([positives[i][0] for i in todo], np.int64)
        windows = Windows(at, start, [high[i] for i in todo], False, k)
        found = stored(_search(rows, anchors, windows), "found")
        full = {r["window"] for r in found.groupBy("window").count().where(F.col("count") == k).select("window").collect()}
        done = [w for w in range(len(todo)) if last or w in full]
        about = rows.sparkSession.createDataFrame(
            [(w, int(anchors[positives[todo[w]][0]]["vec_id"]), int(positives[todo[w]][1]), min(max(scores[todo[w]], _LOW), _HIGH)) for w in done],
            "window long, anchor_id long, positive_id long, positive_score long",
        )
        found.join(F.broadcast(about), "window").select(
            "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.greatest(F.lit(_LOW), F.least(F.lit(_HIGH), "score")).cast("long").alias("negative_score"),
        ).write.mode("append").parquet(path)
        todo = [i for w, i in enumerate(todo) if w not in full]
