"""Connected components of an edge table, by alternating large and small stars.

Each round is two joins and two partial minima, written to the shared folder, so lineage stays short
and a lost executor costs one scan. A node of any degree is handled by Spark's skew join and by
minima taken before the shuffle; no node's neighbours ever meet in one task. Joins are by merge: the
files of edges are far smaller than their rows, so their size does not tell what the driver can hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.shared import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node linked to the smallest node around it."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours linked to the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionAll(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (two columns); root is the smallest node reachable.

    Links of a node to itself and repeated links are allowed; nodes without a link get no row.
    """
    a, b = links.columns[:2]
    edges = stage(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "edges",
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        starred = _large_star(edges)
        edges = stage(_small_star(starred).distinct(), "edges")
    node = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return node.unionAll(roots)
