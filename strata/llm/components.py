"""Connected components of an edge table, by Spark joins alone.

Each round makes the label of a node the smallest label among itself and its
neighbours, then follows labels of labels (pointer jumping), so the number of
rounds grows with the logarithm of a component's width. Every round is a table in
the shared folder: a lost executor costs a re-read, never the earlier rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import write_table


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node reachable.

    Edges are undirected, may repeat and may be loops. A hot node costs one row
    for each map task in the aggregations (partial minima), and joins on it are
    ones that Spark can split.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    links = write_table(both.where("u <> v").select(F.least("u", "v").alias("u"),
                                                    F.greatest("u", "v").alias("v")).distinct(),
                        "edges")
    # star contraction: link every node to its smallest neighbour, replace each edge by
    # the edge between the roots found so far, until only stars are left
    parents = None
    while True:
        ends = links.select("u", "v").union(links.select(F.col("v"), F.col("u")))
        best = (ends.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
                .select("node", F.least("node", "least").alias("root")))
        best = write_table(best, "parents")
        hop = best.select(F.col("node").alias("root"), F.col("root").alias("up"))
        best = best.join(hop, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        best = write_table(best, "parents")
        if parents is None:
            parents = best
        else:
            step = best.select(F.col("node").alias("root"), F.col("root").alias("up"))
            parents = write_table(parents.join(step, "root", "left")
                                  .select("node", F.coalesce("up", "root").alias("root")), "labels")
        left = best.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        right = best.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        links = write_table(links.join(left, "u").join(right, "v").where("ru <> rv")
                            .select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v"))
                            .distinct(), "edges")
        if links.isEmpty():
            return parents
