"""Connected components by alternating large-star and small-star rounds.

Every round is joins and grouped minima over the edge table, so hub nodes
are pre-aggregated before the shuffle and their join partitions can be split;
each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foehn.llm.store import stored


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v); the component is
    its smallest node. Loops and repeated edges are allowed; edges with a
    null end are ignored; no edges give no rows."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), (F.col("u") != F.col("v")).alias("proper"))
    now = stored(spark, edges.where("proper").select("u", "v").distinct(), "edges")
    while not _is_star_forest(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(below, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(spark, moved.unionByName(below.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether each node points to one node and none points on: then the
    edges are the components."""
    up = edges.select(F.col("u").alias("node"), F.lit(1).alias("as_u"), F.lit(0).alias("as_v"))
    down = edges.select(F.col("v").alias("node"), F.lit(0).alias("as_u"), F.lit(1).alias("as_v"))
    ends = up.unionByName(down).groupBy("node").agg(F.sum("as_u").alias("as_u"), F.max("as_v").alias("as_v"))
    return ends.where("as_u > 1 or (as_u = 1 and as_v = 1)").isEmpty()
