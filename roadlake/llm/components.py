"""Connected components of an edge table by alternating large and small stars.

Every round is two aggregations and two joins by vertex; vertices that a third
of the edges share are pre-aggregated (minimum) or sit on the many side of a
join to one row, which adaptive execution splits.  Rounds grow with the
logarithm of the number of vertices.  Nothing but a count and a checksum
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import store


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(id, component)``, the smallest id each can reach.

    Only vertices with an edge to another vertex are returned; null ends, self
    loops and repeated edges change nothing; no edges give no rows.
    """
    e = store(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = _mark(e)
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = store(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = store(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        now = _mark(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
