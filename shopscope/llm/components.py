"""Connected components of an edge table: alternating large-star and small-star rounds.

Each round is two groupings by vertex; a vertex with very many neighbours only
ever needs their minimum, so nothing is collected per vertex. The edges that each
star gives are written to the shared folder and removed when the next ones are: a plan
holds one star, and its joins are planned and broadcast once. The rounds end when a round leaves
the edges unchanged: every vertex then points to its component's smallest one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.shared import removed, stored


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    # repeated rows, at most as many as edges, go with the small star
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # every row has v < u: point each neighbour, and u itself, to u's least neighbour
    least = _least(edges)
    near = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): every vertex of an edge that joins two different vertices and the
    smallest vertex reachable from it. Null ends and loops are no links."""
    now = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    (now, at), last = stored(now, "edges"), None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state["n"] == 0 or state == last:
            break
        last = state
        for star in (_large_star, _small_star):
            before = at
            now, at = stored(star(now), "edges")
            removed(edges.sparkSession, before)
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
