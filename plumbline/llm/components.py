"""Connected components of an edge table, by rounds of contraction.

In each round every node points to the smallest node next to it (itself included) and the
edges are rewritten between those targets.  At least half of the nodes that still have an
edge vanish per round.  The tables of the rounds lie in the shared folder; no group is
gathered in one task, and joins meet stored tables, so Spark can split a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``edges(a, b)``; the component is its smallest node.

    Edges with a null end or equal ends are ignored; repeated edges count once.  No edges
    give no rows.
    """
    left = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    found = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        target = stored(lowest.select("node", F.least("node", "low").alias("target")), "targets")
        if found is None:
            found = target
        else:
            step = target.select(F.col("node").alias("target"), F.col("target").alias("next"))
            found = stored(
                found.join(step, "target", "left").select(
                    "node", F.coalesce("next", "target").alias("target")
                ),
                "targets",
            )
        ends = [target.select(F.col("node").alias(x), F.col("target").alias(f"{x}_to")) for x in "ab"]
        moved = left.join(ends[0], "a").join(ends[1], "b").where("a_to <> b_to")
        left = stored(
            moved.select(
                F.greatest("a_to", "b_to").alias("a"), F.least("a_to", "b_to").alias("b")
            ).distinct(),
            "edges",
        )
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.withColumnRenamed("target", "component")
