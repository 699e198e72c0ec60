"""Indirect lineage: what can be reached over any number of stages.

Lineage falls into parts that no edge joins.  Those small enough for one task are closed there, so
that pairs are only ever written as results; a larger one doubles the length of known paths in
each round, over tables stored in the shared folder.  A cycle simply adds nothing new.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from plumbline.session import stored

# Executors need not have this package installed: its task code travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Nodes and edges of a part that one task closes, and pairs of one table that it gives.
PART_NODES, PART_EDGES, GIVEN = 1024, 1 << 16, 1 << 18


def stage_edges(lineage: DataFrame) -> DataFrame:
    """``(source, target)`` between artifacts: a stage reads the source and writes the target.

    ``lineage`` is ``(stage, artifact, direction)`` with direction ``dep`` or ``out``.
    """
    read = lineage.where("direction = 'dep'").select("stage", F.col("artifact").alias("source"))
    written = lineage.where("direction = 'out'").select("stage", F.col("artifact").alias("target"))
    return read.join(written, "stage").select("source", "target").distinct()


def parts(edges: DataFrame) -> DataFrame:
    """``(node, part)`` for every node of ``edges(source, target)`` with an edge to another one.

    ``part`` is one node of those that edges join, in whatever direction.  Every node points to
    the first one next to it, itself included, in an order that is drawn anew in each round, and
    the edges move to where their ends point; what is left of a chain is about half.
    """
    left = edges.where("source <> target").select(F.col("source").alias("a"), F.col("target").alias("b"))
    steps = []
    while not steps or not left.isEmpty():
        drawn = lambda c, n=len(steps): F.struct(F.xxhash64(F.lit(n), F.col(c)).alias("draw"), F.col(c).alias("node"))
        both = left.union(left.select("b", "a"))
        first = both.groupBy(F.col("a").alias("node")).agg(F.min(drawn("b")).alias("first"))
        step = stored(first.select("node", F.least(drawn("node"), "first")["node"].alias("part")), "step")
        steps.append(step)
        ends = [step.select(F.col("node").alias(x), F.col("part").alias(f"{x}_to")) for x in "ab"]
        moved = left.join(ends[0], "a").join(ends[1], "b").where("a_to <> b_to")
        left = stored(moved.select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).distinct(), "edges")
    found = steps.pop()
    for step in reversed(steps):
        onward = found.select(F.col("node").alias("part"), F.col("part").alias("_end"))
        found = step.join(onward, "part", "left").select("node", F.coalesce("_end", "part").alias("part"))
    return found


def _pairs(table: pa.Table) -> Iterator[pa.Table]:
    """All pairs that paths join, of a table of whole parts, ordered by part."""
    ends = pa.chunked_array([*table.column("source").chunks, *table.column("target").chunks]).combine_chunks().dictionary_encode()
    node = ends.indices.to_numpy()
    source, target = node[: table.num_rows], node[table.num_rows :]
    part = table.column("part").combine_chunks().dictionary_encode().indices.to_numpy()
    bounds = [*np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist(), len(part)]
    out, size = [], 0
    for a, b in zip(bounds, bounds[1:], strict=False):
        nodes, place = np.unique(np.append(source[a:b], target[a:b]), return_inverse=True)
        reach = np.zeros((len(nodes), len(nodes)), np.float32)
        reach[place[: b - a], place[b - a :]] = 1
        known, count = 0, np.count_nonzero(reach)
        while count > known:
            # Paths of up to twice as many edges.
            reach = np.minimum(reach + reach @ reach, 1)
            known, count = count, np.count_nonzero(reach)
        out.append([nodes[x] for x in np.nonzero(reach)])
        size += count
        if size >= GIVEN or b == len(part):
            columns = [ends.dictionary.take(pa.array(np.concatenate(x))) for x in zip(*out, strict=True)]
            yield pa.table(columns, ["source", "target"])
            out, size = [], 0


def _closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_pairs`` of batches ordered by part; the last part of a batch may go on in the next."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        part = table.column("part").combine_chunks().dictionary_encode().indices.to_numpy()
        whole = int(np.flatnonzero(np.append(True, part[1:] != part[:-1]))[-1]) if len(part) else 0
        rest = table.slice(whole)
        if whole:
            for found in _pairs(table.slice(0, whole)):
                yield from found.combine_chunks().to_batches()
    if rest is not None and rest.num_rows:
        for found in _pairs(rest):
            yield from found.combine_chunks().to_batches()


def closure(edges: DataFrame) -> DataFrame:
    """``(source, target)`` for every pair that a path of one edge or more joins.

    Parts of ``PART_NODES`` nodes and ``PART_EDGES`` edges at most are closed in one task
    each, by squaring the matrix of what is reached; larger ones by ``_doubled``.  Edges with a
    null end are ignored; a node on a cycle reaches itself.  The result can be as large as
    the square of a chain; use ``reachable`` when only some starts matter.
    """
    step = edges.where("source is not null and target is not null").select("source", "target")
    step = stored(step.distinct(), "reach")
    part = F.coalesce("part", "source").alias("part")
    named = stored(step.join(parts(step).withColumnRenamed("node", "source"), "source", "left").select("source", "target", part), "parts")
    # A part that is connected has one node more than edges at most.
    sizes = named.groupBy("part").agg(F.count("*").alias("edges"))
    crowded = sizes.where(F.col("edges") >= PART_NODES)
    if not crowded.isEmpty():
        dense = named.join(crowded.where(F.col("edges") <= PART_EDGES), "part")
        ends = dense.select("part", F.explode(F.array("source", "target")).alias("node"))
        few = ends.distinct().groupBy("part").agg(F.count("*").alias("nodes")).where(F.col("nodes") <= PART_NODES)
        crowded = crowded.join(few, "part", "left_anti")
    crowded = crowded.select("part")
    large = stored(crowded, "large")
    some = not large.isEmpty()
    small = named.join(large, "part", "left_anti") if some else named
    kind = StructType([StructField(c, step.schema["source"].dataType) for c in ("source", "target")])
    found = small.repartition("part").sortWithinPartitions("part").mapInArrow(_closed, kind)
    return found.union(_doubled(named.join(large, "part", "left_semi").select("source", "target"))) if some else found


def _doubled(step: DataFrame) -> DataFrame:
    """The closure of distinct edges, by rounds that double the length of known paths.

    A pair whose shortest path is longer than the paths known so far starts with one that
    the last round found, so only those are extended, by everything known.
    """
    known = fresh = stored(step, "reach")
    while not fresh.isEmpty():
        onward = known.select(F.col("source").alias("target"), F.col("target").alias("_end"))
        longer = fresh.join(onward, "target").select("source", F.col("_end").alias("target")).distinct()
        fresh = stored(longer.join(known, ["source", "target"], "left_anti"), "found")
        known = stored(known.union(fresh), "reach")
    return known


def reachable(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """``(start, node)`` for what each ``start`` reaches, itself included, one edge more a round."""
    step = edges.where("source is not null and target is not null").select("source", "target").distinct()
    known = fresh = stored(starts.select("start", F.col("start").alias("node")).where("start is not null").distinct(), "reach")
    while not fresh.isEmpty():
        further = fresh.join(step, F.col("node") == F.col("source")).select("start", F.col("target").alias("node")).distinct()
        fresh = stored(further.join(known, ["start", "node"], "left_anti"), "found")
        known = stored(known.union(fresh), "reach")
    return known


def indirect_leaks(lineage: DataFrame, held_out: Sequence[str], stages: Sequence[str]) -> DataFrame:
    """``(start, artifact, stage)``: a stage reads what came, over any stages, from a held-out artifact."""
    starts = lineage.sparkSession.createDataFrame([(a,) for a in held_out], "start string")
    found = reachable(stage_edges(lineage), starts)
    read = lineage.where((F.col("direction") == "dep") & F.col("stage").isin(*stages)).select("stage", "artifact").distinct()
    return found.withColumnRenamed("node", "artifact").join(read, "artifact").select("start", "artifact", "stage")
