"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of ``links(a, b)``.

    Alternates two star steps until nothing changes: each node hands its larger
    neighbours, then its smaller ones, to the smallest node it knows.  Both are a
    partially aggregated minimum and a join, so a node with many neighbours is
    never gathered in one task.  Links with a null end or equal ends are ignored.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "components")
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(small.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        last, edges = edges, written(small, "components")
        discard(last)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == known:
            break
        known = now
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
