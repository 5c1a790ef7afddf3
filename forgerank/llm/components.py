"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is one shuffle with partial aggregation and leaves each component the same;
labels fall towards the smallest id. The edges of each step are written to the shared
checkpoint folder, so no lineage grows and a lost executor only re-reads files. A node
with very many neighbours costs rows in proportion to them, never pairs of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import release, shared


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): the smallest id reachable from each id that has an edge to another."""
    cur = shared(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                 .where("a <> b").distinct(), "edges")
    state = _state(cur)
    while state[0]:
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: each larger neighbour of a node goes to the node's smallest neighbour.
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # Small star: a node and its smaller neighbours go to the smallest of these.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(low.select("a", F.col("m").alias("b")))).distinct()
        last, cur = cur, shared(small, "edges")
        release(last)
        now = _state(cur)
        if now == state:
            break
        state = now
    return cur.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).union(
        cur.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
