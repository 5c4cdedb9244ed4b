"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineside.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``root``, the least node it can reach, for every node that has an edge to another one.

    Minima are partial aggregates and no neighbourhood is gathered, so a node may have any number of edges. Each round
    is settled in the shared folder. NULL ends and loops are left out, repeated edges count once, no edges give no rows.
    """
    now = settle(edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if state == before or not state["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        now = settle(_small_star(_large_star(now)).distinct(), "edges")
