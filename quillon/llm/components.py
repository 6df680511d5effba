"""Connected components of links, as DataFrames: the large-star and small-star rounds, lineage cut after each.

A node with very many links is no bottleneck: its minimum is a map-side aggregate, and the join that hands it back is one
that Spark can split. Nothing is collected but a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.plans.lineage import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: for every node of ``links``, the smallest node that its links reach. Self-links and repeats don't matter."""
    edges = cut(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        # Large star: each node hands its larger neighbours to its smallest one.
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        # Small star: each node, and its smaller neighbours, to the smallest of them.
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(down, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(moved.unionByName(down.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # Done when every node has one link, and it leads to a node that has none.
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not seen.filter("up > 1 or (up = 1 and down = 1)").limit(1).count():
            return edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("root")), F.struct(F.col("v").alias("node"), F.col("v").alias("root")))).alias("e")).select("e.*").distinct()
