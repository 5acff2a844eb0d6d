"""Connected components of an edge list, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillframe.llm.common import stored


def _low_neighbour(edges: DataFrame, keep: Column) -> DataFrame:
    """(child, parent): neighbours that `keep` names get their node's smallest neighbour, or the node itself, as parent."""
    least = edges.groupBy("a").agg(F.min("b").alias("__least"))
    return edges.join(least.select("a", F.least("a", "__least").alias("parent")), "a").filter(keep).select(
        F.col("b").alias("child"), "parent")


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) of every node with an edge to another in `edges` (child bigint, parent bigint); root is the component's smallest node.

    Alternates large-star and small-star steps until nothing changes: a logarithmic
    number of rounds, each two joins and two sums over one row per edge. Every round is
    written to the shared scratch folder. A node with very many neighbours is summed
    before the shuffle, and its join rows can be split by adaptive execution.

    Defined cases: repeated edges, edges of a node to itself and edges with a null end change nothing; no edges give no nodes.
    """
    now = stored(edges.filter("child <> parent").select(F.greatest("child", "parent").alias("child"),
                                                        F.least("child", "parent").alias("parent")).distinct(), label)
    seen = None
    while (state := now.agg(F.count("*"), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)"))).first()) != seen and state[0]:
        seen = state
        both = now.select(F.col("child").alias("a"), F.col("parent").alias("b")).union(
            now.select(F.col("parent").alias("a"), F.col("child").alias("b")))
        large = _low_neighbour(both, F.col("b") > F.col("a")).filter("child <> parent").distinct()
        least = large.groupBy("child").agg(F.min("parent").alias("least"))
        small = large.join(least, "child").select(F.explode(F.array("child", "parent")).alias("child"), F.col("least").alias("parent"))
        now = stored(small.filter("child <> parent").distinct(), label)
    return now.select(F.col("child").alias("node"), F.col("parent").alias("root")).union(
        now.select("parent", "parent").distinct())
