"""Connected components of a graph given as a table of edges, by DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.scratch import materialise

MAX_ROUNDS = 60


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Return ``node, component`` (the smallest node reachable) for every node of an edge.

    Alternates two star contractions: every node points its larger, then its smaller
    neighbours at the smallest one it knows, until nothing changes. The number of rounds
    is logarithmic in practice; the edge table never grows. Neighbour minima are combined before the shuffle, so a
    node with very many edges costs one row per task; the join that follows is an ordinary
    shuffled join, whose oversized partitions adaptive execution splits. Every round is
    written to the shared folder, which cuts the lineage. Null ends and loops are no
    edges; repeated edges count once. Runs jobs while it builds the result.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now = materialise(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    rounds = 0
    while not _stars(now):
        rounds += 1
        if rounds > MAX_ROUNDS:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (
            both.join(low, F.col("u") == F.col("k"))
            .where("v > u AND v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = (
            large.join(low, F.col("u") == F.col("k"))
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        now = materialise(small, "edges")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node points at one other, and that one at none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("met")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    degree = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("met").alias("met"))
    return degree.where("out > 1 OR (out = 1 AND met = 1)").isEmpty()
