"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Each step is two pre-aggregated minima and two joins that deal the edges of a node with
very many neighbours to many tasks, so they are never collected in one place. Edges are written after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import stage
from .semijoin import split_join


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("rows"))
    return split_join(both.where("b > a"), least, "a", "rows", 2 * total, F.xxhash64("b")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("rows"))
    moved = split_join(down, least, "a", "rows", total, F.xxhash64("b")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: integers); component is the smallest node reachable."""
    edges = stage.written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before, total = None, edges.count()
    for _ in range(most_rounds):
        last, edges = edges, stage.written(_small_star(stage.written(_large_star(edges, total), "stars"), total).where("a <> b").distinct(), "edges")
        stage.discard(last)
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before, total = state, state[0]
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
