"""Connected components as joins and aggregations.

Each round hooks every node's larger neighbours to its smallest neighbour (large
star), then its smaller neighbours likewise (small star). Nothing but two sums per
round reaches the driver. A node of any degree is summed before it is joined, and
adaptive execution splits its rows in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from risklake.llm.scratch import dropped, kept


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) with u > v after one star operation on edges (u, v)."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("center"), F.least("m", "u").alias("m") if large else F.col("m"))
    hooked = edges.join(least, edges.u == least.center)
    if large:
        return hooked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    moved = hooked.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(hooked.select("u", F.col("m").alias("v"))).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and two sums that name them, observed while they are written."""
    seen = Observation()
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    table = kept(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("sum")), "edges")
    return table, (seen.get["n"], seen.get["sum"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """For every node of an edge, the smallest node it can reach: (node, component), written."""
    given = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now, sign = _written(given.distinct())
    before = None
    while sign != before:
        before, (after, sign) = sign, _written(_star(_star(now, large=True), large=False))
        dropped(now)
        now = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.distinct())
