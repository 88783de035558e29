"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the smallest node reachable.

    Each step points nodes at the smallest neighbour of a neighbour; the number of steps grows
    with the logarithm of the longest path. A hub's smallest neighbour is a partial aggregate and
    comes back through a join on the hub that adaptive execution may split, so no task holds a
    hub's neighbours together. Links are stored after each step; only their number and a digest
    reach the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    seen = None
    while True:
        edges = stored(edges, "edges")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == seen or not state["n"]:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large")
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = moved.unionByName(small.select("a", F.col("m").alias("b"))).distinct()
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
