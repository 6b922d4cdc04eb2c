"""Connected components of a table of links, named by their smallest node.

Rounds of two steps (each node's larger neighbours, then its smaller ones, linked to the
smallest known) turn every component into a star. Each round writes its links to the
shared folder, which cuts the lineage; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.shared import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than a node are linked to the smallest around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("m").alias("u"), "v")
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these.

    ``edges`` has u < v in each row.
    """
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    joined = edges.join(least, "v")
    down = joined.where(F.col("u") != F.col("m")).select(
        F.col("m").alias("u"), F.col("u").alias("v")
    )
    return down.unionByName(least.select(F.col("m").alias("u"), "v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``links`` (u, v); null ends and loops are left out."""
    edges = (
        links.where(F.col("u") != F.col("v"))
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )
    edges = written(edges, "links")
    while True:
        edges = written(_small_star(_large_star(edges)), "links")
        # Stars: no node is both a centre and a leaf, no leaf has two centres.
        leaves = edges.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        loose = leaves.where(F.col("n") > 1).select("v").unionByName(
            edges.select(F.col("u").alias("v")).join(leaves, "v", "left_semi").select("v")
        )
        if loose.isEmpty():
            break
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    )
