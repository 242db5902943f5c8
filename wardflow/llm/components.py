"""Connected components of a link table, by alternating large-star and
small-star steps: a few rounds of grouped minimum and equi join, each
checkpointed in the shared folder.  Links never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("big", "small").cast("decimal(20,0)"))).first()
    return tuple(r)


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node
    reachable.  Null ends and self links are ignored; repeated links and
    either order are fine; an empty table gives an empty result."""
    edges = cut(links.where(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small")).distinct())
    before = _state(edges)
    while before[0]:
        # large star: every larger neighbour of a node moves to the smallest one
        both = edges.select(F.col("big").alias("u"), F.col("small").alias("v")).union(
            edges.select(F.col("small").alias("u"), F.col("big").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("big"), F.col("m").alias("small"))
                 .distinct())
        # small star: a node and its smaller neighbours move to the smallest of them
        low = large.groupBy("big").agg(F.min("small").alias("m"))
        small = (large.join(low, "big").where("small <> m")
                 .select(F.col("small").alias("big"), F.col("m").alias("small"))
                 .union(low.select("big", F.col("m").alias("small"))).distinct())
        edges = cut(small)
        after = _state(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("big").alias("node"), F.col("small").alias("root"))
            .union(edges.select("small", "small").distinct()))
