"""Data-quality expectations: predicates that warn, drop or fail.

A null predicate counts as failed.  Counts come from an ``Observation`` on the
plan that does the work, so they cost no second pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class ExpectationFailed(RuntimeError):
    pass


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"  # warn, drop or fail


def warn(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate)


def drop(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, "drop")


def fail(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, "fail")


def _holds(e: Expectation):
    return F.coalesce(F.expr(e.predicate), F.lit(False))


#: The metric that holds how many rows an observation saw.
ROWS = "_rows"


def apply(df: DataFrame, rules: list[Expectation], observation: Observation | None = None, total: bool = False) -> DataFrame:
    """``df`` without rows that break a drop rule; a row that breaks a fail rule raises when it is computed.  ``total`` has the observation count all rows too."""
    if observation is not None and rules:
        df = df.observe(observation, *[F.sum(F.when(_holds(e), 0).otherwise(1)).alias(e.name) for e in rules], *([F.count(F.lit(1)).alias(ROWS)] if total else []))
    for e in rules:
        if e.action == "drop":
            df = df.where(_holds(e))
        elif e.action == "fail":
            df = df.where(_holds(e) | F.raise_error(F.lit(f"expectation {e.name} failed: {e.predicate}")).cast("boolean"))
    return df


def report(df: DataFrame, dataset: str, rules: list[Expectation]) -> DataFrame:
    """(dataset, rule, action, passed, failed, pass_pct) of each rule, in one aggregation over ``df``."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.coalesce(F.sum(F.when(_holds(e), 1).otherwise(0)), F.lit(0)).alias(f"_p{i}") for i, e in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(dataset).alias("dataset"), F.lit(e.name).alias("rule"), F.lit(e.action).alias("action"), F.col(f"_p{i}").cast("long").alias("passed"), (F.col("_n") - F.col(f"_p{i}")).cast("long").alias("failed")) for i, e in enumerate(rules)])
    pct = F.round(F.lit(100.0) * F.col("passed") / F.nullif(F.col("passed") + F.col("failed"), F.lit(0)), 2)
    return counts.select(F.explode(rows).alias("r")).select("r.*").withColumn("pass_pct", pct)


def unique_key(df: DataFrame, *keys: str) -> DataFrame:
    """(rows, keys, is_unique) of a key."""
    both = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.struct(*keys)).alias("keys"))
    return both.withColumn("is_unique", F.col("rows") == F.col("keys"))


def row_count_band(counts: DataFrame, low: float = 0.5, high: float = 2.0) -> DataFrame:
    """``counts`` (dataset, day, n) with ``usual`` (mean of the other days) and whether n is outside [low, high] times that."""
    total = counts.groupBy("dataset").agg(F.sum("n").alias("_sum"), F.count(F.lit(1)).alias("_days"))
    usual = (F.col("_sum") - F.col("n")) / F.nullif(F.col("_days") - 1, F.lit(0))
    out = counts.join(total, "dataset").withColumn("usual", usual.cast("double"))
    return out.select("dataset", "day", "n", "usual", F.coalesce((F.col("n") < low * F.col("usual")) | (F.col("n") > high * F.col("usual")), F.lit(False)).alias("is_anomaly"))
