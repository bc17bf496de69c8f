"""Connected components of links, by alternating large-star and small-star steps.

Each step is a minimum per vertex (summed in part before the shuffle) and a join that AQE can split, so a hub with any
number of links never meets in one task; nothing is collected but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.scratch import table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v). Large: every larger neighbour of u links to the least one; small: every smaller neighbour and u do."""
    both = edges.union(edges.select("v", "u")).distinct() if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of all vertices of ``edges`` (columns u, v): the least vertex that each one reaches."""
    now = table(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    while True:
        now = table(_star(_star(now, True), False), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(now.select("v", "v").distinct()).distinct()
