"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import discard, left_lookup, staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is the smallest node.

    Rounds of contraction: every node points to its smallest neighbour, pointers
    are followed to their ends, and the edges between the ends that remain are
    the next round's.  Ends when no edge is left; the number of nodes at least
    halves in a round.  A node with very many edges is only ever reduced by a
    minimum or looked up.
    """
    left = staged(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a < b")
        .distinct(),
        "edges",
    )
    ends = None
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = staged(
            both.groupBy("a").agg(F.min("b").alias("b")).select(
                F.col("a").alias("node"), F.least("a", "b").alias("root")
            ),
            "pointers",
        )
        while True:
            before = point
            onward = point.select(F.col("node").alias("via"), F.col("root").alias("next"))
            point = staged(
                left_lookup(before, onward, "root", "via", "node").select(
                    "node",
                    F.col("next").alias("root"),
                    (F.col("next") != F.col("root")).alias("moved"),
                ),
                "pointers",
            )
            discard(before)
            if point.filter("moved").limit(1).count() == 0:
                break
        known = point.select(F.col("node").alias("key"), F.col("root").alias("next"))
        if ends is None:
            ends = staged(point.select("node", "root"), "roots")
        else:
            earlier = ends
            ends = staged(
                left_lookup(earlier, known, "root", "key", "node").select(
                    "node", F.coalesce("next", "root").alias("root")
                ),
                "roots",
            )
            discard(earlier)
        moved = left_lookup(left, known, "a", "key", "b").select(F.col("next").alias("a"), "b")
        moved = left_lookup(moved, known, "b", "key", "a").select("a", F.col("next").alias("b"))
        older = left
        left = staged(
            moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .filter("a < b")
            .distinct(),
            "edges",
        )
        discard(older, point)
        if left.limit(1).count() == 0:
            return ends
