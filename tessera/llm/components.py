"""Connected components by alternating large-star and small-star steps; no group is ever gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """vertex and component (the least vertex reachable) of every vertex that has an edge.

    edges has the long columns a and b. Each round joins every edge with the minimum of its vertex, a one-row-per-vertex
    side, and is written to the shared folder; the edges end as stars around their minima. A vertex on which a third
    of all edges meet is only ever summed (map-side minima) or split by the skew join.
    """
    ends = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    stars, before = materialize(ends.distinct(), compact=True), None
    for _ in range(most_rounds):
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(stars.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = small.select(F.col("hi"), F.col("m").alias("lo")).union(small.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        stars = materialize(small.distinct(), compact=True)
        state = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = stars.select(F.col("lo").alias("hi"), "lo").distinct()
    return stars.union(roots).select(F.col("hi").alias("vertex"), F.col("lo").alias("component"))
