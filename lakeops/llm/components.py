"""Connected components of a link table by alternating star rounds, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeops.session import discard, materialize


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root): every node of ``links`` (columns a, b, comparable, not NULL) with the smallest node it reaches.

    A large-star round hangs every larger neighbour of a node on the node's smallest neighbour; a small-star round
    hangs the node and its smaller neighbours there. Rounds end when neither changes the links; their number grows
    with the logarithm of the longest path. Each step is one aggregate and one join on node ids; a hub with many
    links is split by skewed-join handling, its minimum pre-aggregated. Steps are written to the shared folder, and
    deleted when the next one is.
    """
    links = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .filter("a < b").distinct())
    state = None
    while True:
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
        least = both.groupBy("node").agg(F.min("other").alias("other")).select(
            "node", F.least("node", "other").alias("root"))
        large = materialize(both.filter("other > node").join(least, "node")
                            .select(F.col("root").alias("a"), F.col("other").alias("b")))
        # Links now point from the smaller (a) to the larger (b) node: a node's smaller neighbours are its a's.
        down = large.groupBy("b").agg(F.min("a").alias("root"))
        hung = large.join(down, "b").select("root", F.explode(F.array("a", "b")).alias("b"))
        old, links = links, materialize(hung.select(F.col("root").alias("a"), "b").filter("a < b").distinct())
        discard(old, large)
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == state:
            break
        state = now
    nodes = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.union(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
