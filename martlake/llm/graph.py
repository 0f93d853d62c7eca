"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import drop_stage, stage


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """node, component (smallest node reachable) for each node of ``edges`` (a, b) that is not itself the smallest.

    Alternates large-star and small-star steps, each a pre-aggregated minimum
    per node and a join, until no edge changes; every round is written to the
    shared folder.  Rounds grow with the logarithm of the longest chain.
    """
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
              .distinct(), "edges")
    n = e.count()
    for _ in range(max_rounds):
        if n == 0:
            break
        # large star: every larger neighbour points at the smallest neighbour
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node's smaller neighbours, and the node, point at the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        new = stage(small, "edges")
        many = new.count()
        # both are sets: equal when they are as many and one holds the other
        same = many == n and new.join(e, ["a", "b"], "left_anti").isEmpty()
        drop_stage(e)
        e, n = new, many
        if same:
            break
    else:
        raise RuntimeError("components: no fixed point yet; raise max_rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
