"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import save


def _stars(edges: DataFrame, up: bool) -> DataFrame:
    """Link every neighbour (``up``: only larger ones; otherwise only smaller ones and the node itself) of a node to the
    least node of its neighbourhood."""
    if up:
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    else:
        both = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("least"))
    joined = both.join(least, "src")
    if up:
        out = joined.where(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    else:
        out = joined.select(F.col("dst").alias("src"), F.col("least").alias("dst")).unionByName(
            least.select("src", F.col("least").alias("dst")))
    return out.where(F.col("src") != F.col("dst")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``(src, dst)`` -> ``(node, component)`` for every node of an edge; a component is named by its least node.

    Each round links the larger neighbours of every node to the least one around it, then the smaller ones; the
    rounds end when nothing changes (about the logarithm of the number of nodes). A node with very many edges is a
    skewed join key, which adaptive execution splits. Rounds are written to the shared folder.
    """
    current = save(edges.where(F.col("src") != F.col("dst")).select("src", "dst").distinct(), "edges")
    mark = None
    while True:
        current = save(_stars(_stars(current, True), False), "edges")
        now = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    return current.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
        current.select(F.col("dst").alias("node"), F.col("dst").alias("component"))).distinct()
