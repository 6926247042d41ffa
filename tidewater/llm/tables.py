"""Reading the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(columns: list[str], name: str) -> str:
    """``name``, made longer until no column has it, whatever the case of its letters."""
    have = {c.lower() for c in columns}
    while name.lower() in have:
        name += "_"
    return name
