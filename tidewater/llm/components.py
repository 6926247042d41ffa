"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import written


#: Below so many rows one task can hold any key's rows.
FEW = 1_000_000
#: A key is hot if it has more than this part of all rows; so there are at most so many hot keys.
PARTS = 1000


def join_hot(rows: DataFrame, keyed: DataFrame, key: str | list[str], count: str, total: int, few: int | None = None) -> DataFrame:
    """``rows`` joined with ``keyed``, which has one row a key and in ``count`` how many of ``rows`` bear it; ``total`` is their number.

    Rows of a hot key stay where they are: the hot keys' rows of ``keyed``, PARTS
    at most, are broadcast.  The others are joined by shuffling.
    """
    own = keyed.drop(count)
    hot = keyed.where(F.col(count) > total / PARTS).drop(count).limit(PARTS).collect() if total > (FEW if few is None else few) else []
    if not hot:
        return rows.join(own, key)
    few_keys = F.broadcast(rows.sparkSession.createDataFrame(hot, own.schema))
    rest = rows.join(few_keys.select(key), key, "left_anti").join(own, key)
    return rows.join(few_keys, key).unionByName(rest)


def _least(pairs: DataFrame) -> DataFrame:
    """(u, m, d): the least of each u and its neighbours v, and their number; pre-aggregated, so a hot node costs one row a task."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("d"))


def connected_components(edges: DataFrame, most: int = 50, few: int | None = None) -> DataFrame:
    """(node, component): every node of ``edges`` (u, v: long) with the least node of its component.

    Each round replaces edges by edges to smaller nodes, until every node points
    at its component's least; the number of rounds grows with the logarithm of a
    component's length.  Edges never leave the executors; a round's are written
    to the shared folder.  Self-loops and repeated edges change nothing; rows
    with a null are left out.
    """
    own = written(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark, total = None, own.count()
    for _ in range(most):
        both = own.unionByName(own.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # every larger neighbour of u points at the least around u
        large = join_hot(both.where("v > u"), _least(both), "u", "d", 2 * total, few).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = written(large.distinct())
        # u (larger than its v's) and its v's point at the least of them
        small = join_hot(large, _least(large), "u", "d", total, few)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v")
        own = written(small.distinct())
        now = own.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark, total = now, now[0]
    else:
        raise RuntimeError(f"components didn't settle in {most} rounds")
    least = own.select(F.col("v").alias("node")).distinct()
    return own.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(least.select("node", F.col("node").alias("component")))
