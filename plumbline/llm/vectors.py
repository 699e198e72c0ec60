"""Near copies among embeddings: an inverted multi-index over the halves of vectors.

Each half has its own codebook, learnt from a bounded sample; a pair of codewords is a cell
of a grid.  A vector visits cells in the order of the summed distances of its halves to the
codewords, as many as the target recall needs, and is compared in double precision with
all vectors in them.  How many that is, is measured on the sample: the rank of the cell of a
copy that is only just similar enough.  Cells are cut into tiles of bounded size, so a full
cell is many tasks; a tile reports link counts and a forest of its links, never all pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.text import small_batches
from plumbline.session import stored

#: Vectors of a tile on either side (2 x 1024 x 64 doubles are 1 MB; their product is 8 MB).
TILE = 1024
#: Vectors from which codebooks are learnt and the number of visits is measured.
SAMPLE = 16_384
#: Codewords of a half at most: the grid of cells has 2**18 cells or fewer.
CODEWORDS = 512


@dataclass
class Grid:
    """Codebooks of the two halves, and how many cells a vector visits."""

    left: np.ndarray
    right: np.ndarray
    visits: int

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        return _squared(x[:, :half], self.left), _squared(x[:, half:], self.right)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)

    def visited(self, x: np.ndarray, chunk: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """The nearest ``visits`` cells of each vector, and the distance of the last of them.

        A cell among the nearest ``v`` joins codewords that are among the nearest ``v`` of
        their half, so only those are combined.
        """
        cells, reach = [], []
        for i in range(0, len(x), chunk):
            a, b = self.distances(x[i : i + chunk])
            at_a, at_b = (np.argsort(d, axis=1, kind="stable")[:, : self.visits] for d in (a, b))
            near_a, near_b = (np.take_along_axis(d, at, 1) for d, at in ((a, at_a), (b, at_b)))
            both = (near_a[:, :, None] + near_b[:, None, :]).reshape(len(a), -1)
            best = np.argsort(both, axis=1, kind="stable")[:, : self.visits]
            p, q = np.divmod(best, near_b.shape[1])
            cells.append(np.take_along_axis(at_a, p, 1) * len(self.right) + np.take_along_axis(at_b, q, 1))
            reach.append(np.take_along_axis(both, best, 1)[:, -1])
        return np.concatenate(cells), np.concatenate(reach)


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres**2).sum(axis=1) - 2 * (x @ centres.T) + (x**2).sum(axis=1)[:, None]


def _codebook(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _squared(x, centres).argmin(axis=1)
        counts = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, x[:, d], k) for d in range(x.shape[1])], axis=1)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def learn_grid(sample: np.ndarray, total: int, least: float, recall: float = 0.995, seed: int = 7) -> Grid:
    """Codebooks for ``total`` unit vectors, and the visits that reach the target recall.

    A copy of a sample vector is turned away by the angle at which it is only just a link,
    in a random direction; links found on either side count, so this is the harder case.
    """
    rng = np.random.default_rng(seed)
    k = int(min(CODEWORDS, len(sample), max(1, math.sqrt(total / 64))))
    half = sample.shape[1] // 2
    grid = Grid(_codebook(sample[:, :half], k, rng), _codebook(sample[:, half:], k, rng), 1)
    base = sample[rng.permutation(len(sample))[:1000]]
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(axis=1, keepdims=True) * base
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)
    copies = least * base + math.sqrt(max(0.0, 1 - least * least)) * away
    ranks = np.minimum(_ranks(grid, base, copies), _ranks(grid, copies, base))
    grid.visits = int(min(k * k, np.quantile(ranks, recall) + 1))
    return grid


def _ranks(grid: Grid, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many cells are nearer to each x than the cell of its y."""
    a, b = grid.distances(x)
    own = grid.cells(y)
    rows = np.arange(len(x))
    reach = a[rows, own // len(grid.right)] + b[rows, own % len(grid.right)]
    sorted_b = np.sort(b, axis=1)
    return np.array([int(np.searchsorted(sb, r - da - 1e-12).sum()) for sb, r, da in zip(sorted_b, reach, a, strict=True)])


def near_vectors(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors(vec_id, embedding)``.

    Two vectors link when their cosine is ``least`` or more.  A vector that is null, empty or
    zero, or holds a null or a non-finite component, links with nothing; so do vectors of
    different length.  Equal vectors are searched once and counted each; a repeated row, or
    another vector under the same vec_id, is a vector of its own.  A row of null vec_id is not searched:
    it links with nothing, counts in no n_links, has no component and is kept.
    """
    rows = small_batches(vectors).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    sound = F.expr(
        "coalesce(size(embedding) > 0 and exists(embedding, x -> x <> 0)"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')), false)"
    )
    # ``rep`` names a class inside this search only: different vectors may share their vec_id.
    classes = stored(
        rows.where(sound & F.col("vec_id").isNotNull())
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "vectors",
    )
    found = None
    for size in sorted(r["n"] for r in classes.select(F.size("embedding").alias("n")).distinct().collect()):
        part = _search(classes.where(F.size("embedding") == size), least)
        found = part if found is None else found.union(part)
    if found is None:
        found = rows.select(F.col("vec_id").alias("rep"), F.col("vec_id").alias("other"), F.lit(0).cast("long").alias("n")).limit(0)
    found = stored(found, "links")
    counts = found.where("other is null").groupBy("rep").agg(F.sum("n").alias("n"))
    linked = components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    linked = linked.withColumnRenamed("node", "rep")
    lowest = linked.join(classes, "rep").groupBy("component").agg(F.min("least").alias("lowest"))
    known = stored(
        classes.join(counts, "rep", "left")
        .join(linked.join(lowest, "component").select("rep", "lowest"), "rep", "left")
        .select(
            "embedding",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
            F.coalesce("lowest", "least").alias("component_id"),
        ),
        "classes",
    )
    return (
        rows.withColumn("embedding", F.when(sound & F.col("vec_id").isNotNull(), F.col("embedding")))
        .join(known, "embedding", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def _search(classes: DataFrame, least: float) -> DataFrame:
    """Per tile: link counts (``other`` null) and edges of a forest of the links (``n`` null)."""
    spark = classes.sparkSession
    total = classes.count()
    sample = classes.orderBy(F.xxhash64("embedding"), "least").limit(SAMPLE).select("embedding").toArrow()
    x = np.array(sample.column(0).to_pylist())
    grid = learn_grid(_unit(x), total, least)
    shared = spark.sparkContext.broadcast(vars(grid))

    def place(batches):
        grid = Grid(**shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(_matrix(batch.column(0)))
            own, (cells, reach) = grid.cells(x), grid.visited(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), batch.column(0), pa.array(own), pa.array(list(cells), pa.list_(pa.int64())), pa.array(reach)],
                ["rep", "weight", "embedding", "own", "cells", "reach"],
            )

    placed = stored(
        classes.select("embedding", "rep", "weight").mapInArrow(
            place, "rep long, weight long, embedding array<double>, own long, cells array<long>, reach double"
        ),
        "placed",
    )
    # Tiles: each cell's vectors in blocks, its visitors in chunks.  A row per cell, 2**18 at most.
    stock = placed.groupBy(F.col("own").alias("cell")).agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    guests = placed.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("chunks"))
    plan = F.broadcast(stored(stock.join(guests, "cell"), "tiles"))
    salt = F.xxhash64("rep")
    held = placed.join(plan, placed["own"] == plan["cell"]).select(
        "cell", F.pmod(salt, F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.lit(True).alias("held"), "rep", "weight", "embedding", "own", "reach",
    )
    asks = placed.select(F.explode("cells").alias("cell"), "rep", "weight", "embedding", "own", "reach").join(plan, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(salt, F.col("chunks")).cast("int").alias("chunk"),
        F.lit(False).alias("held"), "rep", "weight", "embedding", "own", "reach",
    )

    def compare(tile: pa.Table) -> pa.Table:
        grid = Grid(**shared.value)
        held = tile.column("held").to_numpy()
        x = _unit(_matrix(tile.column("embedding").combine_chunks()))
        rep, weight, own, reach = (tile.column(c).to_numpy() for c in ("rep", "weight", "own", "reach"))
        ask, has = np.flatnonzero(~held), np.flatnonzero(held)
        link = (x[ask] @ x[has].T >= least) & (rep[ask][:, None] != rep[has][None, :])
        if not link.any():
            return pa.table({"rep": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        # The one asked counts the link here unless it visits the asker's cell itself.
        a, b = np.nonzero(link)
        d, e = grid.distances(x[has])
        cell = own[ask]
        comes = d[b, cell[a] // len(grid.right)] + e[b, cell[a] % len(grid.right)] <= reach[has][b]
        n = np.zeros(len(rep), np.int64)
        np.add.at(n, ask[a], weight[has[b]])
        np.add.at(n, has[b[~comes]], weight[ask[a[~comes]]])
        # Smallest reachable rep inside the tile, by rounds over the links.
        top = np.iinfo(np.int64).max
        low_ask, low_has = rep[ask].copy(), rep[has].copy()
        while True:
            new_ask = np.minimum(low_ask, np.where(link, low_has[None, :], top).min(axis=1, initial=top))
            new_has = np.minimum(low_has, np.where(link, new_ask[:, None], top).min(axis=0, initial=top))
            if (new_ask == low_ask).all() and (new_has == low_has).all():
                break
            low_ask, low_has = new_ask, new_has
        low = np.empty(len(rep), np.int64)
        low[ask], low[has] = low_ask, low_has
        tree = np.unique(np.stack([rep, low], axis=1)[rep != low], axis=0)
        some = np.flatnonzero(n)
        return pa.table(
            {
                "rep": pa.array(np.concatenate([rep[some], tree[:, 0]])),
                "other": pa.array([None] * len(some) + tree[:, 1].tolist(), pa.int64()),
                "n": pa.array(n[some].tolist() + [None] * len(tree), pa.int64()),
            }
        )

    tiles = held.union(asks).groupBy("cell", "block", "chunk")
    return tiles.applyInArrow(compare, "rep long, other long, n long")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
