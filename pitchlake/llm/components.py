"""Connected components of an edge table by repeated contraction; nothing passes through the driver but one count a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.scratch import cut


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root): the smallest node reachable from each node that has an edge.

    Every round points each node at the smallest of itself and its neighbours, follows
    the pointers once more, and replaces the ends of each edge by their pointers; edges
    within one node go. Every node that is not the smallest among its neighbours goes in each
    round, so a group linked through hubs takes two or three rounds. Self edges and
    repeated edges are allowed; edges with a null end are ignored.
    """
    live = cut(
        edges.select("a", "b").where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    root: DataFrame | None = None
    while live.count():
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("up"))
        up = cut(up, "pointers")
        step = up.select(F.col("node").alias("up"), F.col("up").alias("upper"))
        up = cut(up.join(step, "up", "left").select("node", F.coalesce("upper", "up").alias("up")), "pointers")
        if root is None:
            root = up.select("node", F.col("up").alias("root"))
        else:
            moved = up.select(F.col("node").alias("root"), F.col("up").alias("higher"))
            root = cut(root.join(moved, "root", "left").select("node", F.coalesce("higher", "root").alias("root")), "roots")
        ends = live
        for side in ("a", "b"):
            moved = up.select(F.col("node").alias(side), F.col("up").alias(f"_{side}"))
            ends = ends.join(moved, side).drop(side).withColumnRenamed(f"_{side}", side)
        live = cut(
            ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
        )
    if root is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return root
