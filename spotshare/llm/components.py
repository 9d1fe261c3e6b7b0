"""Connected components of a graph given as edges, by Spark joins and a written table for each round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spotshare.plans.staging import write_stage


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The smallest node reachable from every node that has an edge: columns ``node`` and ``root``.

    ``edges`` has the orderable columns ``a`` and ``b``; direction, repeats and loops don't matter, a NULL end drops the
    edge, and no edges give no rows. Each round hangs every node and its larger neighbours on its smallest neighbour
    (pre-aggregated minima, then joins), which halves long chains; the edges that are left are written to the shared folder.
    Ends when every node has one edge, straight to a root. A chain longer than ``max_rounds`` can shorten raises.
    """
    edges = write_stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    for _ in range(max_rounds):
        # hang every node's larger neighbours on the smallest of the node and its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        low = write_stage(low, "minima")
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        large = write_stage(large, "large")
        # hang every node's smaller neighbours on the smallest of them
        low = write_stage(large.groupBy("a").agg(F.min("b").alias("m")), "minima")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = write_stage(small, "edges")
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("a").alias("nodes")).first()
        if seen["n"] == seen["nodes"] and edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
