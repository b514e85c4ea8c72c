"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node in ``links`` (two long columns a, b).

    Large star and small star in turn, each of which hangs nodes below the smallest known neighbour, until nothing moves;
    the number of rounds grows with the logarithm of the longest path. A node with very many neighbours is met by partial
    sums and by joins that adaptive execution can split. Every round is written to the shared folder, so lineage stays
    short. Links with a null end and loops are ignored.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        # Large star: every larger neighbour of a node is linked to the smallest neighbour.
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node's smaller neighbours are linked to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        links = stored(small, "links")
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
