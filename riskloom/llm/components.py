"""Connected components of a link table by alternating stars; all work stays in shuffles.

Every step takes minima per vertex, which combine before the shuffle, and joins them back, so a
vertex with very many links never needs one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.store import Scratch


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on (u, v) links, v below u. Every vertex points to the smallest it knows."""
    if large:
        seen = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = edges
    least = seen.groupBy("u").agg(F.min("v").alias("low"))
    least = least.select("u", F.least("u", "low").alias("low")) if large else least
    joined = seen.join(least, "u")
    if large:
        new = joined.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        new = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionAll(
            least.select("u", F.col("low").alias("v")))
    return new.where("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """(vertex, root) for every vertex of ``links``; the root is the smallest vertex reachable.

    Links with a null end and links of a vertex with itself are ignored. The number of rounds
    grows with the logarithm of the longest chain.
    """
    edges = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = scratch.save(edges)
    state = _state(edges)
    while True:
        new = scratch.save(_stars(_stars(edges, True), False))
        scratch.drop(edges)
        edges = new
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    return roots.unionAll(edges.select(F.col("v").alias("vertex"), F.col("v").alias("root"))
                          .distinct())
