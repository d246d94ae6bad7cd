"""Connected components of an edge table that is never gathered anywhere.

Alternating star contraction: a large-star step links each node's larger
neighbours to its smallest neighbour, a small-star step links its smaller ones.
Both keep the components and turn every component into one star around its
smallest node in O(log n) rounds.  A round is aggregations (partial, so a hot
node ships one row per task) and sort-merge joins (which AQE splits on skew);
its result is written to the shared folder, in place of the round before.
Components that are stars already take no part in the next round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import cut, drop_cuts


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = _least(both).select("u", F.least("m", "u").alias("m"))
    return (both.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    m = _least(edges)
    linked = edges.join(m, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionAll(m.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(u, v) pairs of one comparable type -> (node, component), where
    ``component`` is the smallest node that ``node`` reaches.  Only nodes of an
    edge between different nodes are returned; null ends are no edge."""
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
              .distinct(), name)
    closed, kept = [], []
    while True:
        # no star yet: a centre one of whose leaves has two centres or is a centre, or that hangs from another
        ends = now.select("u", F.lit(1).alias("n")).unionAll(now.select("v", F.lit(0)))
        ends = ends.groupBy("u").agg(F.sum("n").alias("leaf"), F.min("n").alias("low")).where("leaf + 1 - low > 1 and leaf > 0")
        loose = cut(ends.select("u"), f"{name}-loose")
        if not loose.take(1):
            drop_cuts(loose)
            break
        centres = now.join(loose, "u", "left_semi").select("v").unionAll(loose).distinct().withColumnRenamed("v", "c")
        # a star has no edge to what is still open, so only that goes on
        flagged = cut(now.join(centres, now.v == centres.c, "left").select("u", "v", F.isnotnull("c").alias("open")), name, now, loose)
        closed.append(flagged.where("not open").select("u", "v"))
        kept.append(flagged)
        large = cut(_large_star(flagged.where("open")), name)
        now = cut(_small_star(large), name, large)
    if closed:
        now = cut(reduce(DataFrame.unionAll, closed, now), name, now, *kept)
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
