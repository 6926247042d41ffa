"""Sending this package to Python workers that don't have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

BATCH, DEFAULT_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: give the package's source to all executors, through Spark's own file server, and bound the Arrow batches that go to Python."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    root = Path(__file__).resolve().parent  # the package
    handle, name = tempfile.mkstemp(prefix=f"{root.name}-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as out:
        for p in sorted(root.rglob("*.py")):
            out.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(name)
    if spark.conf.get(BATCH) == DEFAULT_BATCH:  # a batch is held several times over, in the JVM and in Python
        spark.conf.set(BATCH, "8m")
    _sent.add(sc.applicationId)
