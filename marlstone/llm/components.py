"""Connected components of a table of links, by contracting them round after round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.folders import kept


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): the smallest node of its component.

    In a round every node joins its smallest neighbour and links are renamed after that; those within a
    node go. Each round at least halves the nodes that still have links. Nodes without links to others
    are not returned. Ties and repeated links do not matter.
    """
    links = kept(links.select("a", "b").filter("a <> b").distinct())
    labels = None
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min("b").alias("m"))
        step = kept(step.select(F.col("a").alias("n"), F.least("a", "m").alias("m")))
        if labels is None:
            labels = step.select(F.col("n").alias("node"), F.col("m").alias("label"))
        else:
            moved = labels.join(step, F.col("label") == F.col("n"), "left")
            labels = kept(moved.select("node", F.coalesce("m", "label").alias("label")))
        half = links.join(step, F.col("a") == F.col("n")).select(F.col("m").alias("a"), "b")
        whole = half.join(step, F.col("b") == F.col("n")).select("a", F.col("m").alias("b"))
        pairs = whole.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        links = kept(pairs.distinct())
    if labels is None:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
