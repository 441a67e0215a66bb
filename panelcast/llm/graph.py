"""Connected components by alternating stars (Kiveris et al., 2014), on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b) that isn't its component's smallest.

    Each round hangs a node's larger neighbours, then its smaller ones, on its smallest neighbour.
    Rounds grow with the logarithm of the longest path. A round is written to the shared folder and
    read back; nothing but a checksum comes to the driver.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, mark = stored(edges, "links"), None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum")).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = hung.groupBy("u").agg(F.min("v").alias("m"))
        moved = hung.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = stored(moved.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "links")
