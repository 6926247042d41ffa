"""Groups that links connect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import discard, written


def connected(links: DataFrame, left: str = "u", right: str = "v", most: int = 60) -> DataFrame:
    """(node, least): every node of the links, of any orderable type, with the least node it is connected to.

    Rounds of two steps, each one aggregation and one join by node: larger
    neighbours are linked to a node's least one, then a node and its smaller
    neighbours to the least of them.  Long chains halve with each round.  Links
    stay on the executors and are written to the shared folder between steps.
    Links to itself, repeated ones, and those with a null change nothing.
    """
    now = written(_ordered(links, left, right))
    sign = None
    for _ in range(most):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = written(both.where("v > u").join(around, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v")
        after = written(small.distinct())
        discard(now, large)
        now = after
        told = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if told == sign:
            break
        sign = told
    else:
        raise RuntimeError(f"groups didn't settle in {most} rounds")
    least = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("least")).unionByName(least.select("node", F.col("node").alias("least")))


def _ordered(links: DataFrame, left: str, right: str) -> DataFrame:
    some = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    return some.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
