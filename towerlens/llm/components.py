"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.sources.workspace import written


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links ``(high, low)`` with ``high > low``.

    Every neighbour moves to the least node around it; the number of links never grows beyond what
    it was, whatever the degree of a node. Both minima are combined before they are shuffled.
    """
    both = links.union(links.select(F.col("low"), F.col("high"))).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.withColumn("least", F.least("least", "node"))
    large = (
        both.join(least, "node").where("other > node").select(F.col("other").alias("high"), F.col("least").alias("low"))
    ).distinct()
    roots = large.groupBy("high").agg(F.min("low").alias("root"))
    moved = large.join(roots, "high").where("low > root").select(F.col("low").alias("high"), F.col("root").alias("low"))
    return roots.toDF("high", "low").union(moved).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``links`` ``(high, low)``; a component is named by its least node.

    Links are undirected; repeated links, links of a node with itself and nulls are ignored. Each round is
    written to the shared folder, so a lost executor never costs more than one round.
    """
    links = links.toDF("a", "b").where("a <> b")
    links = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    links, before = written(links, "links"), None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            roots = links.select("low").distinct().select("low", "low")
            return links.union(roots).toDF("node", "component")
        links, before = written(_stars(links), "links"), now
