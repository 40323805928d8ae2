"""Connected components of an edge table by alternating stars.

Every round hangs each vertex under the smallest vertex it knows: the large
star links a vertex's larger neighbours with its smallest one, the small star
its smaller neighbours.  Both are a partially aggregated minimum per vertex
and an equi-join, so a vertex with very many neighbours is split by adaptive
skew handling and no neighbourhood is ever collected.  Edges stay as many as
they were; rounds grow with the logarithm of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegraph.llm.common import materialise


def _star(both: DataFrame, larger: bool) -> DataFrame:
    """``u, v`` with v a neighbour of u: link v (and u itself) with the smallest of u's circle."""
    lowest = both.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("w"), F.least("u", "low").alias("low"))
    joined = both.join(lowest, F.col("u") == F.col("w"))
    if larger:
        out = joined.where("v > u").select("v", F.col("low").alias("u"))
    else:
        out = joined.select("v", F.col("low").alias("u")).unionByName(
            lowest.select(F.col("w").alias("v"), F.col("low").alias("u")))
    return out.where("v > u").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reached) for every vertex of ``edges`` (``a, b``)."""
    down = materialise(
        edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("v > u").distinct(), "edges")
    seen = None
    while True:
        both = down.select("u", "v").unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, larger=True)
        down = materialise(_star(large.select(F.col("v").alias("u"), F.col("u").alias("v")), larger=False), "edges")
        # a star forest no longer changes
        now = down.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = down.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    return down.select(F.col("v").alias("id"), F.col("u").alias("component")).unionByName(roots)
