"""Connected components of an edge table, by alternating large-star and
small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014).

Each step is a grouped minimum and an equi-join on the same key, so a hub's
edges are reduced map-side and its join partition can be split; the edges are
written to the shared folder after each round, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) hold both directions.  Large star: neighbours above u go to
    u's minimum; small star: u and its neighbours below go there."""
    to_low = edges.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    side = edges.where(F.col("v") > F.col("u") if large else F.col("v") < F.col("u"))
    moved = side.join(to_low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(to_low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge in `edges` (a, b); the
    component is its smallest node.  Self-loops and repeats do no harm."""
    now = materialize(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        now = materialize(_star(_both(_star(_both(now), True)), False), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
