"""Connected components of a link table, by contraction, with nothing gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.storing import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every end of the links (a, b); root is one node of the component.

    In each round every node points to the smallest of itself and its neighbours, and links are
    rewritten to what their ends point to, until none joins two nodes. Node numbers must be
    spread like hashes, so that a fixed share of the nodes disappears in each round. An empty
    table gives an empty one; loops and repeated links change nothing.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long"))
    nodes = (links.select(F.col("a").alias("node"))
             .unionByName(links.select(F.col("b").alias("node"))).distinct())
    labels = stored(nodes.select("node", F.col("node").alias("root")))
    links = stored(links.where("a <> b").distinct())
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = stored(both.groupBy("a").agg(F.min("b").alias("low"))
                        .select(F.col("a").alias("at"), F.least("a", "low").alias("to")))
        links = stored(
            links.join(points, F.col("a") == F.col("at"), "left")
            .select(F.coalesce("to", "a").alias("a"), "b")
            .join(points, F.col("b") == F.col("at"), "left")
            .select("a", F.coalesce("to", "b").alias("b"))
            .where("a <> b").distinct())
        labels = stored(labels.join(points, F.col("root") == F.col("at"), "left")
                        .select("node", F.coalesce("to", "root").alias("root")))
    return labels
