"""Connected components of an edge list, as joins and aggregates that halve distances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (u, v) but the roots themselves; root: the smallest node
    reachable.

    Alternates two steps until every component is a star around its root (about log of the diameter
    times): each node's larger neighbours are moved to the smallest node it sees, then its smaller
    ones. No node's neighbours are ever gathered in one place: minima are aggregates, and the moves
    are joins, where a node with very many neighbours can be split."""
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "cc")
    for _ in range(rounds):
        if _stars(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        down = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))  # u > v
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        now = stored(down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, or only edges from above."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    seen = ends.groupBy("n").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return seen.agg(F.count_if((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0)))).first()[0] == 0
