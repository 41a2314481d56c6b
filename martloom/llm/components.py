"""Connected groups of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import many_to_one, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node it reaches.

    Large-star and small-star steps in turn: every step hangs nodes on the smallest one they know,
    so edges stay no more than nodes and edges, and stop changing after a few rounds. A centre with
    many neighbours is met where they are; see ``many_to_one``.
    """

    def star(both: DataFrame, rows: int) -> DataFrame:
        """Each node's neighbours hang on the smallest of the node and its neighbours."""
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        met = many_to_one(both, least, ["a"], rows)
        return met.select("a", "b", F.least("a", "m").alias("m"))

    def settled(pairs: DataFrame) -> tuple[DataFrame, tuple]:
        kept = stored(pairs.where("a != b").distinct())
        mark = kept.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return kept, tuple(mark)

    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now, mark = settled(edges.select(high, low))
    while mark[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both, 2 * mark[0]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a != b").distinct())
        hung = star(large, mark[0])
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            hung.select("a", F.col("m").alias("b"))
        )
        now, after = settled(small.select(high, low))
        if after == mark:
            break
        mark = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
