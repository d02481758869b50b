"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.plans.shaping import cut_lineage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` (the least node it is connected with) for the nodes
    of ``edges`` (columns ``a``, ``b``; order, loops and repeats do not matter).

    Alternates "large star" (every larger neighbour is linked to the node's
    least neighbour) and "small star" (every smaller one is) until all
    components are stars; the number of rounds grows with the logarithm of the graph.  A
    node's least neighbour is a combining aggregate and the join back to the
    edges is an ordinary shuffle join that can be split at run time, so a hub
    is no hot task.  Every round is a written table."""
    e = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), name)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_lineage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        # done when every node points at one other, and that one at none
        forks = e.groupBy("u").count().filter("count > 1").select("u")
        chains = e.select("u").join(e.select(F.col("v").alias("u")), "u", "left_semi")
        if forks.unionByName(chains).isEmpty():
            break
    stars = e.groupBy("u").agg(F.min("v").alias("component"))
    roots = e.select("v").distinct().join(stars.select(F.col("u").alias("v")), "v", "left_anti")
    return stars.withColumnRenamed("u", "node").unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
