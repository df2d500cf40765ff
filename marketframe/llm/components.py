"""Connected components of an undirected graph by alternating star contraction (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; component = smallest node reachable.

    Each round hangs every node's larger neighbours, then its smaller ones, under its smallest neighbour;
    the edge list never grows, minima are pre-aggregated before their shuffle and hub nodes are split by
    the skew join. Every round is checkpointed, so a lost executor costs one round. Self loops and rows
    with a null end are ignored; an empty edge list gives an empty result.
    """
    e = (edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
         .where("u is not null and v is not null and u < v").distinct())
    e = checkpointed(e)
    state = _state(e)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("m").alias("u"), "v"))
        large = large.where("u < v").distinct()
        # small star: every node with its smaller neighbours
        down = large.select(F.col("v").alias("n"), F.col("u").alias("s"))
        least = down.groupBy("n").agg(F.min("s").alias("m"))
        small = (down.join(least, "n")
                 .select(F.explode(F.array(F.struct(F.col("m").alias("u"), F.col("s").alias("v")),
                                           F.struct(F.col("m").alias("u"), F.col("n").alias("v")))).alias("x"))
                 .select("x.*").where("u < v").distinct())
        e = checkpointed(small)
        new = _state(e)
        if new == state and _is_star(e):
            break
        state = new
    else:
        raise RuntimeError("components did not converge")
    return (e.select(F.col("v").alias("node"), F.col("u").alias("component"))
            .unionAll(e.select(F.col("u").alias("node"), F.col("u").alias("component")))
            .groupBy("node").agg(F.min("component").alias("component")))


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return (r[0], r[1])


def _is_star(e: DataFrame) -> bool:
    """No node is both a centre and a leaf, and no leaf has two centres."""
    twice = e.groupBy("v").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    chained = e.join(e.select(F.col("v").alias("u")), "u", "left_semi").limit(1).count()
    return twice == 0 and chained == 0
