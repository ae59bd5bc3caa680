"""Connected components over an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.session import materialise


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node reachable, for every node that has an edge.

    Each round first links every neighbour to the smallest node in sight (large star), then contracts
    what points down (small star). Neighbours are never gathered: minima are pre-aggregated and joined
    back, so a component that holds a third of all nodes is shared out. Rounds are written to the
    shared folder; nothing but a count and a checksum reaches the driver. Empty edges give no rows.
    Raises if max_rounds do not settle, which needs a path of more than 2^(max_rounds/2) nodes.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    e = materialise(e, "edges")
    seen = _sum(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        e = materialise(_small(_large(e)), "edges")
        now = _sum(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(e.select("v", "v").distinct()))


def _sum(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large(e: DataFrame) -> DataFrame:
    both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select("v", "u"))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return both.filter("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    down = e.join(least, "u")
    return (down.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
