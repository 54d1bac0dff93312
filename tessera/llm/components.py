"""Connected components by alternating stars, in joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """edges(u, v) -> (node, root): root is the smallest node that node reaches.

    Only nodes with an edge to another node appear; null ends and loops are left out.
    Large star: every larger neighbour of u points to u's smallest neighbour. Small star:
    u and its smaller neighbours point to the smallest. Both keep the components and end
    in one star each. A round reads the written edges of the round before; minima are
    pre-aggregated, so a node with many neighbours is never gathered in one place.
    """
    now = scratch.keep(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before = None
    for _ in range(most_rounds):
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            break
        before = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        after = scratch.keep(small, "stars")
        scratch.drop(now)
        now = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
