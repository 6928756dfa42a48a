"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import stored


def _nearest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest of u and all its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("n")).select(F.col("u").alias("w"), F.least("u", "n").alias("m"))
    return edges.join(least, F.col("u") == F.col("w"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node reachable.

    Each round is two aggregations and two joins on plain columns, never a list of a
    node's neighbours, and is written to the scratch folder; a node with very
    many edges is split by the skew join.  Rounds end when the edges no longer change.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs, before = stored(pairs, "edges"), None
    while True:
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _nearest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where("u <> v")
        near = _nearest(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
        pairs = stored(small.where("u <> v").distinct(), "edges")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(pairs.select(F.col("u").alias("node"), F.col("v").alias("root")))
