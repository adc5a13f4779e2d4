"""Connected components by alternating large-star and small-star rounds, DataFrame operations only.

Every round is a written table, so lineage stays one round long, and goes when the next one is there. A hub's edges meet its
minimum in a plain join, which adaptive execution splits where one hub has most edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is the smallest node that it reaches.

    Loops and repeated edges count once, edges with a null end don't count; no edges, no rows. The number of
    rounds grows with the logarithm of the longest chain; `rounds` is far beyond that, and reaching it is an error.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    with scratch():
        now = written(pairs, "edges", codec="none")
        mark = _mark(now)
        for _ in range(rounds):
            if mark[0] == 0:
                break
            after = written(_small_star(_large_star(now)), "stars", codec="none")
            fresh = _mark(after)
            now, mark, same = after, fresh, fresh == mark
            if same:
                break
        else:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
        roots = now.select(F.col("b").alias("node")).distinct()
        found = now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
        return written(found, "components", codec="none", keep=True)
