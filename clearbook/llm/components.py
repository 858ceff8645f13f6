"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.shared import apart, back, drop_kept, keep, keep_counted


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node that can be reached.

    Each round is two grouped minima, each joined back by node: partial sums on the map side, and a join whose other side
    is unique, so a node with very many edges is split by adaptive execution. Rounds end when every node is a root or has
    one edge, to a smaller node; the count of the others comes with the first of the minima, so a round that would change
    nothing is not planned. The number of rounds grows with the logarithm of the longest path. Every round is a written table.
    """
    first = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = keep(first, "edges")
    while True:
        both = stars.select("u", "v").unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = both.groupBy("u").agg(
            F.least("u", F.min("v")).alias("m"), F.expr("count_if(v < u) AS below"), F.expr("count_if(v > u) AS above")
        )
        lowest, inner = keep_counted(around, "lowest", (F.col("below") > 1) | (F.col("below") > 0) & (F.col("above") > 0))
        if not inner:
            drop_kept(lowest)
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        large = both.join(lowest.select("u", "m"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = apart(large, "u").agg(F.min("v").alias("m")).select(back("u"), "m")
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = keep(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        drop_kept(stars)
        drop_kept(lowest)
        stars = after
