"""Following links to the end of their chains."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabweave.session import cut_lineage


def chain_ends(links: DataFrame, old: str, new: str) -> DataFrame:
    """(old, new) with ``new`` replaced by what it leads to, until that leads nowhere.

    Pointers are doubled, so a chain of n links takes log2(n) joins. A value with several links
    gets the ends of all of them. Values that only lead to each other (a ring) end at the
    smallest of them. Links with a null end are left out.
    """
    jump = cut_lineage(links.select(F.col(old).alias("a"), F.col(new).alias("b")).dropna().distinct())
    base, starts = jump, jump.select("a").distinct().count()
    for _ in range(math.ceil(math.log2(starts + 1)) + 1):
        joined = jump.join(jump.toDF("b", "c"), ["b"], "left").groupBy("a", F.coalesce("c", "b").alias("b"))
        went = cut_lineage(joined.agg(F.max(F.col("c").isNotNull()).alias("went")))
        jump = went.select("a", "b")
        if went.where("went").isEmpty():
            return jump.toDF(old, new)
    # what is open after so many steps stands in a ring
    ringed = _open(jump)
    ring = cut_lineage(ringed.select(F.col("b").alias("m")).distinct())
    inside = base.join(ring.toDF("a"), ["a"], "left_semi").join(ring.toDF("b"), ["b"], "left_semi").select("a", "b")
    reach, size = cut_lineage(inside), -1
    while size != (size := reach.count()):
        reach = cut_lineage(reach.unionByName(reach.join(reach.toDF("b", "c"), ["b"]).select("a", F.col("c").alias("b"))).distinct())
    # those that reach each other are one ring
    least = reach.join(reach.toDF("b", "a"), ["a", "b"], "left_semi").groupBy("a").agg(F.min("b").alias("least"))
    closed = ringed.join(least.select(F.col("a").alias("b"), "least"), ["b"]).select("a", F.col("least").alias("b"))
    done = jump.join(ring.toDF("b"), ["b"], "left_anti").select("a", "b")
    return done.unionByName(closed).distinct().toDF(old, new)


def _open(jump: DataFrame) -> DataFrame:
    """The rows whose end leads on."""
    return jump.join(jump.select(F.col("a").alias("b")).distinct(), ["b"], "left_semi").select("a", "b")
