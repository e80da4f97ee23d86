"""Connected components of a graph of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabweave.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node it is connected with) of all nodes of ``links`` but the roots.

    Large and small stars in turn: each round hangs the neighbours of a node under its smallest
    neighbour, first the larger ones, then the smaller ones, until nothing changes. A round is an
    aggregation and a join on edges, so a node of any degree is spread over tasks, and the number
    of rounds grows with the logarithm of the longest path.
    """
    edges = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).where("node <> root").distinct()
    edges, state = cut_lineage(edges), None
    while True:
        both = edges.union(edges.select("root", "node"))
        low = both.groupBy("node").agg(F.min("root").alias("low")).withColumn("low", F.least("low", "node"))
        large = both.join(low, "node").where("root > node").select(F.col("root").alias("node"), F.col("low").alias("root")).where("node <> root").distinct()
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        joined = large.join(low, "node")
        small = joined.select("node", F.col("low").alias("root")).union(joined.where("root <> low").select("root", "low")).distinct()
        edges = cut_lineage(small)
        was, state = state, edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if state == was:
            return edges
