"""Decision forests with node sizes and without a depth limit, grown over Spark tables.

Rows are binned once and stored.  Bootstrap weights, and the features that a node looks at,
come from hashes of the row's key and the node's path, and a split is chosen from sums of
integers; so a forest depends on its rows and its seed alone, not on layout, tasks or lost
executors.

Large nodes grow level by level: tasks count (tree, node, feature, bin) cells, Spark sums
them, and each node's best split is chosen from its own cells.  A node that has become
small enough is finished in one task by the same rule over its rows.  Where the whole table
is that small, it is broadcast and every task grows trees from the root.  A test holds all
ways to the same trees.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.errors import ConfigError, DataError
from plumbline.session import stored

#: Bins of a feature; rows by which thresholds are chosen; classes at most.
BINS, THRESHOLD_ROWS, MOST_CLASSES = 256, 1 << 16, 100
#: Rows of a node that one task finishes (its size in memory is this times the features).
FINISH = 1 << 16
#: Cells that one job counts in a task, and rows (over all trees) sent out to be finished by one job.
CELLS, SENT = 1 << 22, 1 << 31
#: Cells of a feature for each row, up to which counting them is cheaper than sorting the rows.
CELLS_A_ROW = 4
#: Nodes of all forests of a search that the driver holds.
MOST_NODES = 20_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Fit:
    """One forest: its trees, what a node needs before and after a split, and the fold it leaves out.

    ``per_node`` features with a valid split are compared at a node.  Sizes count rows, not
    bootstrap weights.
    """

    n_trees: int = 100
    max_depth: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    per_node: int = 1
    seed: int = 42
    without_fold: int | None = None
    bootstrap: bool = True

    def __post_init__(self):
        if self.n_trees < 1 or self.min_split < 2 or self.min_leaf < 1 or self.per_node < 1:
            raise ConfigError(f"not a forest: {self}")
        if self.max_depth is not None and self.max_depth < 1:
            raise ConfigError(f"max_depth must be positive or None, got {self.max_depth}")


@dataclass
class Binned:
    """Stored rows ``rid, y, fold, bins``, with the thresholds and classes that explain them."""

    rows: DataFrame
    features: list[str]
    edges: list[np.ndarray]
    classes: list
    n_rows: int


@dataclass
class Tree:
    """Nodes by number, the root first; a leaf has feature -1.  ``counts`` are weights by class."""

    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    counts: list = field(default_factory=list)

    def add(self, counts: Sequence[float]) -> int:
        for column, value in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.counts, list(counts))):
            column.append(value)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut: int, left: Sequence[float], right: Sequence[float]) -> tuple[int, int]:
        self.feature[node], self.cut[node] = int(feature), int(cut)
        self.left[node], self.right[node] = self.add(left), self.add(right)
        return self.left[node], self.right[node]

    def graft(self, node: int, branch: Tree) -> None:
        """Put a grown branch where ``node`` is a leaf."""
        base = len(self.feature) - 1
        place = lambda i: node if i == 0 else base + i
        for i in range(len(branch.feature)):
            if i:
                self.add(branch.counts[i])
            at = place(i)
            self.feature[at], self.cut[at] = branch.feature[i], branch.cut[i]
            if branch.feature[i] >= 0:
                self.left[at], self.right[at] = place(branch.left[i]), place(branch.right[i])

    def ordered(self) -> Tree:
        """The same tree, its nodes numbered from the root down, left sides first."""
        order, waiting = [], [0]
        while waiting:
            i = waiting.pop()
            order.append(i)
            if self.feature[i] >= 0:
                waiting += (self.right[i], self.left[i])
        place = dict(zip(order, range(len(order)), strict=True)) | {-1: -1}
        pick = lambda column: [column[i] for i in order]
        sides = ([place[i] for i in pick(column)] for column in (self.left, self.right))
        return Tree(pick(self.feature), pick(self.cut), *sides, pick(self.counts))

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x) for x in (self.feature, self.cut, self.left, self.right)) + (np.array(self.counts, float),)


def _thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Midpoints between neighbouring values: all of them, or those at even shares of the rows."""
    distinct = np.unique(values)
    if len(distinct) < 2:
        return np.zeros(0)
    if len(distinct) > bins:
        cut = np.sort(values)[(np.arange(1, bins) * len(values)) // bins]
        upper = np.unique(np.maximum(np.searchsorted(distinct, cut), 1))
    else:
        upper = np.arange(1, len(distinct))
    low, high = distinct[upper - 1], distinct[upper]
    middle = low / 2 + high / 2
    return np.where((middle >= low) & (middle < high), middle, low)


def binned(
    df: DataFrame, features: Sequence[str], target: str, key: Sequence[str], fold: str | None = None, bins: int = BINS
) -> Binned:
    """Bin the features of all rows by thresholds from the rows of smallest key hash.

    With at most ``THRESHOLD_ROWS`` rows and ``bins`` values the thresholds are all midpoints.
    A null or NaN in a feature or in the target is an error: no row is left out.
    """
    if not 2 <= bins <= BINS:
        raise ConfigError(f"bins must be 2..{BINS}, got {bins}")
    numbers = [F.col(f"`{c}`").cast("double") for c in features]
    bad = F.lit(False)
    for c in numbers:
        bad = bad | c.isNull() | F.isnan(c)
    y = F.col(f"`{target}`")
    kept = df.select(
        F.xxhash64(*[F.col(f"`{c}`") for c in key]).alias("rid"),
        y.alias("y"),
        (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
        F.array(*numbers).alias("x"),
        (bad | y.isNull()).alias("bad"),
    )
    kept = stored(kept, "rows")
    about = kept.agg(F.count("*").alias("n"), F.count_if("bad").alias("bad")).first()
    if about["bad"]:
        raise DataError(f"{about['bad']} rows have a null or NaN in {list(features)} or {target!r}")
    if not about["n"]:
        raise DataError("no rows to learn from")
    classes = sorted(r["y"] for r in kept.select("y").distinct().limit(MOST_CLASSES + 1).collect())
    if len(classes) > MOST_CLASSES:
        raise DataError(f"{target!r} has more than {MOST_CLASSES} classes")
    sample = kept.select("rid", "x").orderBy("rid", "x").limit(THRESHOLD_ROWS).toArrow()
    values = sample.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(features))
    edges = [_thresholds(values[:, f], bins) for f in range(len(features))]
    number = F.element_at(F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(i))]), F.col("y"))

    def cut(batches):
        for batch in batches:
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(edges))
            out = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _binary(out)], ["rid", "y", "fold", "bins"])

    rows = kept.select("rid", number.alias("y"), "fold", "x").mapInArrow(cut, "rid long, y int, fold int, bins binary")
    return Binned(stored(rows, "binned"), list(features), edges, classes, about["n"])


def _binary(matrix: np.ndarray) -> pa.Array:
    """The rows of a byte matrix as binary values."""
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, width), np.uint8)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


# Steps of the Poisson distribution of mean 1: a row's weight in a tree.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def weights_of(rid: np.ndarray, fold: np.ndarray, fit: Fit, tree: int) -> np.ndarray:
    """Weight of each row in a tree; 0 for the fold that is left out."""
    if fit.bootstrap:
        salt = np.uint64((fit.seed * 1_000_003 + tree * 7919 + 1) % (1 << 64))
        draw = mix(rid.view(np.uint64) * _ODD ^ mix(np.full(1, salt))) >> np.uint64(11)
        weight = np.searchsorted(_POISSON, draw.astype(float) / float(1 << 53), "right")
    else:
        weight = np.ones(len(rid), np.int64)
    return weight if fit.without_fold is None else weight * (fold != fit.without_fold)


def _root_path(fit: Fit, tree: int) -> np.uint64:
    return mix(np.array([fit.seed * 65_537 + tree + 1], np.uint64))[0]


def _child_paths(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mix(paths * _ODD + np.uint64(1)), mix(paths * _ODD + np.uint64(2))


def _choose(gain: np.ndarray, cut: np.ndarray, paths: np.ndarray, per_node: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(feature, cut, splits)`` for each node, from the best gain and cut of each of its features.

    Of the features with a valid split the first ``per_node`` by hash are compared; equal
    gains go to the first feature.
    """
    valid = gain > -np.inf
    draw = mix(paths[:, None] ^ mix(np.arange(1, gain.shape[1] + 1, dtype=np.uint64) * _ODD)[None, :])
    draw = np.where(valid, draw >> np.uint64(1), np.uint64(1 << 63))
    rank = np.argsort(np.argsort(draw, 1, kind="stable"), 1, kind="stable")
    seen = np.where(valid & (rank < per_node), gain, -np.inf)
    feature = seen.argmax(1)
    at = np.arange(len(gain))
    return feature, cut[at, feature], valid.any(1)


def _gains(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What a split leaves of purity: 1 less the weighted Gini impurity of both sides.

    Rounded, so that splits of equal worth are ties and not ranked by their last bits.
    """
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        worth = (left * left).sum(-1) / left.sum(-1) + (right * right).sum(-1) / right.sum(-1)
        return np.round(worth / total.sum(-1), 12)


def _grows(counts: np.ndarray, sizes: np.ndarray, depth: int, fit: Fit) -> np.ndarray:
    """Nodes that may be split, as far as sizes, purity and depth tell."""
    if fit.max_depth is not None and depth >= fit.max_depth:
        return np.zeros(len(counts), bool)
    return ((counts > 0).sum(1) > 1) & (sizes >= max(fit.min_split, 2 * fit.min_leaf))


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, n_classes: int, fit: Fit, path: np.uint64, depth: int = 0) -> Tree:
    """The branch over these rows, level by level; rows of weight 0 take no part."""
    kept = np.flatnonzero(w)
    bins, y, w = bins[kept], y[kept], w[kept].astype(float)
    tree, at = Tree(), np.zeros(len(y), np.int64)
    tree.add(np.bincount(y, w, minlength=n_classes))
    nodes, paths = np.zeros(1, np.int64), np.array([path], np.uint64)
    while True:
        sizes = np.bincount(at, minlength=len(nodes))
        # No node is left where none of the last level had a valid split.
        counts = np.array([tree.counts[n] for n in nodes.tolist()]).reshape(-1, n_classes)
        go = _grows(counts, sizes, depth, fit)
        if not go.any():
            return tree
        nodes, paths, sizes, counts = nodes[go], paths[go], sizes[go], counts[go]
        inside = go[at]
        at = (np.cumsum(go) - 1)[at[inside]]
        bins, y, w = bins[inside], y[inside], w[inside]
        if len(nodes) * BINS <= CELLS_A_ROW * len(at):
            gain, cut = _best_of_cells(_cells(bins, y, w, at, len(nodes), n_classes), fit.min_leaf)
        else:
            gain, cut = _best_of_rows(bins, y, w, at, sizes, counts, fit.min_leaf)
        feature, where, splits = _choose(gain, cut, paths, fit.per_node)
        goes_left = bins[np.arange(len(at)), feature[at]] <= where[at]
        lefts = np.bincount(at[goes_left] * n_classes + y[goes_left], w[goes_left], minlength=len(nodes) * n_classes).reshape(-1, n_classes)
        children = np.full((len(nodes), 2), -1)
        for i in np.flatnonzero(splits).tolist():
            children[i] = tree.split(nodes[i], feature[i], where[i], lefts[i], counts[i] - lefts[i])
        inside = splits[at]
        side = np.where(goes_left, 0, 1)[inside]
        order = np.cumsum(splits) - 1
        at = 2 * order[at[inside]] + side
        bins, y, w = bins[inside], y[inside], w[inside]
        nodes = children[splits].ravel()
        paths = np.stack(_child_paths(paths[splits]), 1).ravel()
        depth += 1


def _cells(bins, y, w, at, n_nodes, n_classes):
    """Weights by class, and rows, of each (node, feature, bin)."""
    width = bins.shape[1]
    spot = (at[:, None] * width + np.arange(width)) * BINS + bins
    sums = np.empty((n_classes + 1, n_nodes * width * BINS))
    for c in range(n_classes):
        own = y == c
        sums[c] = np.bincount(spot[own].ravel(), np.repeat(w[own], width), minlength=sums.shape[1])
    sums[n_classes] = np.bincount(spot.ravel(), minlength=sums.shape[1])
    return sums.reshape(n_classes + 1, n_nodes, width, BINS)


def _best_of_cells(sums: np.ndarray, min_leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Best gain and cut of each (node, feature), from their cells."""
    n_left = sums[-1].cumsum(-1)
    size = n_left[..., -1:]
    edge = np.flatnonzero((sums[-1] > 0) & (n_left >= min_leaf) & (size - n_left >= min_leaf))
    run = np.moveaxis(sums[:-1].cumsum(-1), 0, -1)
    total = np.broadcast_to(run[..., -1:, :], run.shape).reshape(-1, run.shape[-1])
    gains = np.full(n_left.size, -np.inf)
    gains[edge] = _gains(run.reshape(-1, run.shape[-1])[edge], total[edge])
    gains = gains.reshape(n_left.shape)
    return gains.max(-1), gains.argmax(-1)


def _best_of_rows(bins, y, w, at, sizes, counts, min_leaf):
    """Best gain and cut of each (node, feature), by sorting the rows along each feature."""
    n_nodes, n_features = len(sizes), bins.shape[1]
    gain, cut = np.full((n_nodes, n_features), -np.inf), np.zeros((n_nodes, n_features), np.int64)
    own = np.zeros((len(y), counts.shape[1]))
    own[np.arange(len(y)), y] = w
    base = at * BINS
    starts = np.append(0, np.cumsum(sizes)[:-1])
    place = np.arange(len(y))
    node = np.repeat(np.arange(n_nodes), sizes)
    n_left = place - starts[node] + 1
    roomy = (n_left >= min_leaf) & (sizes[node] - n_left >= min_leaf)
    for f in range(n_features):
        key = base + bins[:, f]
        order = np.argsort(key, kind="stable")
        key = key[order]
        edge = np.flatnonzero(roomy[:-1] & (key[1:] != key[:-1]))
        if not len(edge):
            continue
        run = np.cumsum(own[order], 0)
        before = np.where(starts[:, None] > 0, run[starts - 1], 0.0)
        of = node[edge]
        g = _gains(run[edge] - before[of], counts[of])
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        top = np.maximum.reduceat(g, first)
        who = of[first]
        is_top = np.flatnonzero(g == np.repeat(top, np.diff(np.append(first, len(of)))))
        _, earliest = np.unique(of[is_top], return_index=True)
        gain[who, f], cut[who, f] = top, key[edge[is_top[earliest]]] % BINS
    return gain, cut


def _land(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The node of each row."""
    feature, cut, left, right, _ = tree.arrays()
    at = np.zeros(len(bins), np.int64)
    moving = np.flatnonzero(feature[at] >= 0)
    while len(moving):
        here = at[moving]
        at[moving] = np.where(bins[moving, feature[here]] <= cut[here], left[here], right[here])
        moving = moving[feature[at[moving]] >= 0]
    return at


_TREE = "fit int, tree int, node int, feature array<int>, cut array<int>, left array<int>, right array<int>, counts array<double>"


def _packed(fit: int, number: int, node: int, tree: Tree) -> pa.RecordBatch:
    lists = [[x] for x in (tree.feature, tree.cut, tree.left, tree.right)]
    columns = [pa.array([v], pa.int32()) for v in (fit, number, node)]
    columns += [pa.array(x, pa.list_(pa.int32())) for x in lists]
    columns += [pa.array([np.ravel(tree.counts).tolist()], pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays(columns, ["fit", "tree", "node", "feature", "cut", "left", "right", "counts"])


def _unpacked(row: dict, n_classes: int) -> Tree:
    counts = np.array(row["counts"]).reshape(-1, n_classes).tolist()
    return Tree(list(row["feature"]), list(row["cut"]), list(row["left"]), list(row["right"]), counts)


def grow_forests(data: Binned, fits: Sequence[Fit], finish: int | None = None) -> list[list[Tree]]:
    """The trees of each fit."""
    finish = FINISH if finish is None else finish
    trees = _grow_from_broadcast(data, fits) if data.n_rows <= finish else _grow_by_levels(data, fits, finish)
    if sum(len(t.feature) for f in trees for t in f) > MOST_NODES:
        raise ConfigError(f"the forests have more than {MOST_NODES} nodes; ask for a depth, larger leaves or fewer trees")
    return [[t.ordered() for t in f] for f in trees]


def _grow_from_broadcast(data: Binned, fits: Sequence[Fit]) -> list[list[Tree]]:
    """All trees from their roots over a table of ``FINISH`` rows at most, which every task gets."""
    spark, width, n_classes = data.rows.sparkSession, len(data.features), len(data.classes)
    table = data.rows.toArrow()
    column = lambda c: table.column(c).combine_chunks()
    shared = spark.sparkContext.broadcast(
        (column("rid").to_numpy(), column("y").to_numpy(), column("fold").to_numpy(), _matrix(column("bins"), width), list(fits))
    )
    starts = np.append(0, np.cumsum([f.n_trees for f in fits])).tolist()

    def work(batches):
        rid, y, fold, bins, fits = shared.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                which = int(np.searchsorted(starts, i, "right")) - 1
                fit, number = fits[which], i - starts[which]
                w = weights_of(rid, fold, fit, number)
                yield _packed(which, number, 0, grow(bins, y, w, n_classes, fit, _root_path(fit, number)))

    tasks = min(starts[-1], 4 * spark.sparkContext.defaultParallelism)
    grown = spark.range(0, starts[-1], 1, tasks).mapInArrow(work, _TREE).toArrow().to_pylist()
    out: list[list[Tree]] = [[None] * f.n_trees for f in fits]
    for row in grown:
        out[row["fit"]][row["tree"]] = _unpacked(row, n_classes)
    return out


@dataclass
class _Open:
    """A node that may still grow."""

    fit: int
    tree: int
    node: int
    path: np.uint64
    depth: int
    size: int


def _groups(items: list[_Open], cost, most: int) -> Iterator[list[_Open]]:
    """Runs of items that cost ``most`` together at most, or are one item."""
    some, total = [], 0
    for item in items:
        c = cost(item)
        if some and total + c > most:
            yield some
            some, total = [], 0
        some.append(item)
        total += c
    if some:
        yield some


def _by_tree(items: Iterable[_Open]) -> dict[tuple[int, int], dict[int, _Open]]:
    out: dict[tuple[int, int], dict[int, _Open]] = {}
    for o in items:
        out.setdefault((o.fit, o.tree), {})[o.node] = o
    return out


def _grow_by_levels(data: Binned, fits: Sequence[Fit], finish: int) -> list[list[Tree]]:
    n_classes, width = len(data.classes), len(data.features)
    trees = [[Tree() for _ in range(f.n_trees)] for f in fits]
    level = [_Open(i, t, 0, _root_path(f, t), 0, finish + 1) for i, f in enumerate(fits) for t in range(f.n_trees)]
    small: list[_Open] = []
    cells = width * BINS * (n_classes + 1)
    while level:
        following = []
        for some in _groups(level, lambda _: cells, CELLS):
            for o, counts, size, feature, cut, lefts, left_size in _level_splits(data, fits, trees, some):
                tree, fit = trees[o.fit][o.tree], fits[o.fit]
                if not tree.feature:
                    tree.add(counts)
                if feature < 0:
                    continue
                pair = tree.split(o.node, feature, cut, lefts, np.array(counts) - np.array(lefts))
                paths = [p[0] for p in _child_paths(np.array([o.path], np.uint64))]
                for node, path, n in zip(pair, paths, (left_size, size - left_size), strict=True):
                    if _grows(np.array([tree.counts[node]]), np.array([n]), o.depth + 1, fit)[0]:
                        child = _Open(o.fit, o.tree, node, path, o.depth + 1, n)
                        (small if n <= finish else following).append(child)
        level = following
    for some in _groups(small, lambda o: o.size, SENT):
        for o, branch in _finished(data, fits, trees, some):
            trees[o.fit][o.tree].graft(o.node, branch)
    return trees


def _landed(batch: pa.RecordBatch, width: int, fits, trees, wanted):
    """For each wanted tree: ``(key, bins, y, weights, nodes)`` of the batch's rows that take part."""
    rid, y, fold = (batch.column(i).to_numpy() for i in range(3))
    bins = _matrix(batch.column(3), width)
    for (f, t), nodes in wanted.items():
        w = weights_of(rid, fold, fits[f], t)
        tree = trees[f, t]
        at = _land(tree, bins) if tree.feature else np.zeros(len(y), np.int64)
        inside = np.flatnonzero((w > 0) & np.isin(at, list(nodes)))
        if len(inside):
            yield (f, t), bins[inside], y[inside], w[inside], at[inside]


def _level_splits(data: Binned, fits, trees, some: list[_Open]):
    """Each open node with its counts and best split, from cells that Spark sums."""
    spark, width, n_classes = data.rows.sparkSession, len(data.features), len(data.classes)
    wanted = _by_tree(some)
    place = {(o.fit, o.tree, o.node): i for i, o in enumerate(some)}
    shared = spark.sparkContext.broadcast((list(fits), {k: trees[k[0]][k[1]] for k in wanted}, wanted, place))

    def count(batches):
        fits, trees, wanted, place = shared.value
        span = width * BINS
        sums = np.zeros((n_classes + 1, len(place) * span))
        for batch in batches:
            for (f, t), bins, y, w, at in _landed(batch, width, fits, trees, wanted):
                number = np.array([place.get((f, t, n), -1) for n in range(int(at.max()) + 1)])[at]
                spot = number[:, None] * span + np.arange(width)[None, :] * BINS + bins
                for c in range(n_classes):
                    own = y == c
                    np.add.at(sums[c], spot[own].ravel(), np.repeat(w[own], width))
                np.add.at(sums[n_classes], spot.ravel(), 1)
        used = np.flatnonzero(sums[n_classes])
        for start in range(0, len(used), 1 << 14):
            part = used[start : start + (1 << 14)]
            columns = [pa.array((part // span).astype(np.int32)), pa.array((part % span).astype(np.int32))]
            columns += [pa.array(sums[c][part].astype(np.int64)) for c in range(n_classes + 1)]
            yield pa.RecordBatch.from_arrays(columns, ["open", "cell", *names])

    names = [f"w{c}" for c in range(n_classes)] + ["n"]
    cells = data.rows.mapInArrow(count, "open int, cell int, " + ", ".join(f"{c} long" for c in names))
    cells = cells.groupBy("open", "cell").agg(*[F.sum(c).alias(c) for c in names])

    def best(key, table):
        fits, _, _, _ = shared.value
        o = some_shared.value[key[0].as_py()]
        fit = fits[o.fit]
        sums = np.zeros((n_classes + 1, width, BINS))
        cell = table.column("cell").to_numpy()
        for c, name in enumerate(names):
            sums[c, cell // BINS, cell % BINS] = table.column(name).to_numpy()
        total, n_left = sums[:n_classes, 0].sum(1), sums[n_classes].cumsum(1)
        size = int(n_left[0, -1])
        feature, cut, left, left_size = -1, 0, np.zeros(n_classes), 0
        if _grows(total[None, :], np.array([size]), o.depth, fit)[0]:
            gain, top = _best_of_cells(sums[:, None], fit.min_leaf)
            chosen, where, splits = _choose(gain, top, np.array([o.path], np.uint64), fit.per_node)
            if splits[0]:
                feature, cut = int(chosen[0]), int(where[0])
                left, left_size = sums[:n_classes, feature, : cut + 1].sum(1), int(n_left[feature, cut])
        return pa.table(
            {
                "open": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tolist()]), "size": pa.array([size], pa.int64()),
                "feature": pa.array([feature], pa.int32()), "cut": pa.array([cut], pa.int32()),
                "lefts": pa.array([left.tolist()]), "left_size": pa.array([left_size], pa.int64()),
            }
        )

    some_shared = spark.sparkContext.broadcast(some)
    kind = "open int, counts array<double>, size long, feature int, cut int, lefts array<double>, left_size long"
    for r in cells.groupBy("open").applyInArrow(best, kind).collect():
        yield some[r["open"]], r["counts"], r["size"], r["feature"], r["cut"], r["lefts"], r["left_size"]


def _finished(data: Binned, fits, trees, some: list[_Open]):
    """Each small node with the branch that one task grows over its rows."""
    spark, width, n_classes = data.rows.sparkSession, len(data.features), len(data.classes)
    wanted = _by_tree(some)
    place = {(o.fit, o.tree, o.node): i for i, o in enumerate(some)}
    shared = spark.sparkContext.broadcast((list(fits), {k: trees[k[0]][k[1]] for k in wanted}, wanted, place, some))

    def send(batches):
        fits, trees, wanted, place, _ = shared.value
        for batch in batches:
            for (f, t), bins, y, w, at in _landed(batch, width, fits, trees, wanted):
                number = [place[f, t, n] for n in at.tolist()]
                columns = [pa.array(number, pa.int32()), pa.array(y.astype(np.int32)), pa.array(w.astype(np.int32)), _binary(bins)]
                yield pa.RecordBatch.from_arrays(columns, ["open", "y", "w", "bins"])

    def finish(key, table):
        fits, _, _, _, some = shared.value
        o = some[key[0].as_py()]
        column = lambda c: table.column(c).combine_chunks()
        branch = grow(_matrix(column("bins"), width), column("y").to_numpy(), column("w").to_numpy(), n_classes, fits[o.fit], o.path, o.depth)
        return pa.Table.from_batches([_packed(o.fit, o.tree, o.node, branch)])

    sent = data.rows.mapInArrow(send, "open int, y int, w int, bins binary")
    for row in sent.groupBy("open").applyInArrow(finish, _TREE).toArrow().to_pylist():
        yield some[place[row["fit"], row["tree"], row["node"]]], _unpacked(row, n_classes)


def _votes(trees: Sequence[Tree], bins: np.ndarray, n_classes: int) -> np.ndarray:
    """Mean class shares of the leaves of each row."""
    total = np.zeros((len(bins), n_classes))
    for tree in trees:
        counts = np.array(tree.counts, float)
        total += (counts / np.maximum(counts.sum(1, keepdims=True), 1e-300))[_land(tree, bins)]
    return total / max(len(trees), 1)


def _winner(votes: np.ndarray) -> np.ndarray:
    """The class of most votes; votes that differ in rounding only are equal, and go to the first class."""
    return np.round(votes, 12).argmax(1)


def fold_hits(data: Binned, fits: Sequence[Fit], forests: Sequence[Sequence[Tree]]) -> list[float]:
    """Accuracy of each fit on the fold it left out, in one pass over the rows."""
    n_classes, width = len(data.classes), len(data.features)
    shared = data.rows.sparkSession.sparkContext.broadcast((list(fits), [list(f) for f in forests]))

    def judge(batches):
        fits, forests = shared.value
        hits = np.zeros((len(fits), 2), np.int64)
        for batch in batches:
            y, fold = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            bins = _matrix(batch.column(3), width)
            for i, (fit, trees) in enumerate(zip(fits, forests, strict=True)):
                held = np.flatnonzero(fold == fit.without_fold)
                if len(held):
                    hits[i] += (_winner(_votes(trees, bins[held], n_classes)) == y[held]).sum(), len(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(fits))), pa.array(hits[:, 0]), pa.array(hits[:, 1])], ["fit", "hits", "n"])

    found = data.rows.mapInArrow(judge, "fit long, hits long, n long").groupBy("fit").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect()
    scores = {r["fit"]: r["hits"] / r["n"] if r["n"] else 0.0 for r in found}
    return [scores.get(i, 0.0) for i in range(len(fits))]


@dataclass
class GrownForest:
    """A forest with what it needs to read raw rows: names, thresholds and classes."""

    features: list[str]
    edges: list[np.ndarray]
    classes: list
    trees: list[Tree]
    output: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the class of most votes; a null or NaN feature gives no prediction.

        The forest is broadcast; its nodes are bounded by ``MOST_NODES``.
        """
        shared = df.sparkSession.sparkContext.broadcast((self.edges, self.trees, len(self.classes)))

        @F.arrow_udf("int")
        def classify(*columns: pa.Array) -> pa.Array:
            edges, trees, n_classes = shared.value
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in columns], 1)
            bad = np.isnan(x).any(1)
            bins = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
            return pa.array(_winner(_votes(trees, bins, n_classes)).astype(np.int32), mask=bad)

        place = classify(*[F.col(f"`{c}`").cast("double") for c in self.features])
        names = F.array(*[F.lit(c) for c in self.classes])
        return df.withColumn(self.output, F.get(names, place))

    def node_table(self, spark: SparkSession) -> DataFrame:
        """One row per node: where it is, what it asks, and the class weights it saw."""
        rows = []
        for number, tree in enumerate(self.trees):
            paths = {0: ""}
            for i in range(len(tree.feature)):
                f = tree.feature[i]
                if f >= 0:
                    paths[tree.left[i]], paths[tree.right[i]] = paths[i] + "L", paths[i] + "R"
                asks = (self.features[f], float(self.edges[f][tree.cut[i]])) if f >= 0 else (None, None)
                rows.append((number, paths[i], *asks, float(sum(tree.counts[i]))))
        return spark.createDataFrame(rows, "tree int, path string, feature string, threshold double, weight double")

    def describe(self) -> str:
        """All trees as text; equal forests have equal texts."""
        return "\n".join(json.dumps([t.feature, t.cut, t.left, t.right, t.counts]) for t in self.trees)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the trees as a table and the rest as one line of JSON, replacing what is there."""
        kind = "tree int, feature array<int>, cut array<int>, left array<int>, right array<int>, counts array<double>"
        rows = [(i, t.feature, t.cut, t.left, t.right, np.ravel(t.counts).tolist()) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, kind).write.mode("overwrite").parquet(f"{path}/trees")
        about = {"features": self.features, "edges": [e.tolist() for e in self.edges], "classes": self.classes, "output": self.output}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/forest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GrownForest:
        about = json.loads(spark.read.text(f"{path}/forest", wholetext=True).first()[0])
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        trees = [_unpacked(r.asDict(), len(about["classes"])) for r in rows]
        return cls(about["features"], [np.array(e) for e in about["edges"]], about["classes"], trees, about["output"])


def fit_forest(df: DataFrame, features: Sequence[str], target: str, key: Sequence[str], fit: Fit, bins: int = BINS, finish: int | None = None) -> GrownForest:
    """One forest over all rows of ``df``; ``key`` names rows, and so fixes what each tree draws."""
    data = binned(df, features, target, key, bins=bins)
    return GrownForest(data.features, data.edges, data.classes, grow_forests(data, [fit], finish)[0])
