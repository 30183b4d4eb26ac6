"""Connected components of a graph given as edges, by alternating large and small stars.

Each round hangs every node's larger neighbours (large star) or smaller neighbours (small
star) on the least node it knows, until every component is one star. The least neighbour
is found by an aggregate with map-side combine, so a node of very many edges is not one
task's work; rounds are written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
            .filter("u <> v").distinct())


def _state(edges: DataFrame):
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of ``edges`` (u, v)."""
    edges = staged(edges.select("u", "v").filter("u <> v"), "edges")
    before = None
    while True:
        edges = staged(_small(_large(edges)), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select("component", "component")).distinct()
