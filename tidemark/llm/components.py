"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table


def _lowest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour per node, merged inside each task before the shuffle, then written.

    Joins below read two written tables, so adaptive execution can split the rows of a hub.
    """
    return shared_table(edges.groupBy("u").agg(F.min("v").alias("low")), "star-low")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; ``links`` has two id columns.

    The component is its smallest node. Each round is written to the shared folder, which cuts
    the lineage. The number of rounds grows with the logarithm of the longest path.
    """
    a, b = (F.col(c) for c in links.columns)
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, mark = shared_table(edges, "star-edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both)
        star = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("low", "u").alias("v"))
        star = shared_table(star.where("u <> v").distinct(), "star-large")
        low = _lowest(star)
        moved = star.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = shared_table(moved.unionByName(low.select("u", F.col("low").alias("v"))).distinct(), "star-small")
        # Hashes are cut to 32 bits so that their sum stays a long.
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit(0xFFFFFFFF))), F.max("u"), F.sum(F.hash("v", "u").cast("long"))).first()
        if seen == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = seen
