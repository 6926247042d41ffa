"""Tables written to the shared checkpoint folder, to cut lineage between steps."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
#: Paths of the tables written by this process; '' once deleted.
_made: list[str] = []
_place: weakref.WeakKeyDictionary[DataFrame, int] = weakref.WeakKeyDictionary()


def folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; unset, a temporary folder in local mode, else the warehouse, which executors share too."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_steps"
    if "at" not in _local:
        _local["at"] = tempfile.mkdtemp(prefix="tidewater-")
        atexit.register(shutil.rmtree, _local["at"], ignore_errors=True)
    return "file://" + _local["at"]


def _path(spark: SparkSession, name: str):
    """A path of the JVM's, and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder, and read again; its shuffles can go, and a lost executor costs nothing that is done.

    The table lasts until :func:`discard` or :func:`drop`, or until the driver ends.
    """
    spark = df.sparkSession
    name = f"{folder(spark)}/tidewater-{uuid.uuid4().hex}"
    df.write.parquet(name)
    path, system = _path(spark, name)
    system.deleteOnExit(path)
    out = spark.read.schema(df.schema).parquet(name)
    _place[out] = len(_made)
    _made.append(name)
    return out


def place(spark: SparkSession) -> str:
    """A new folder below the shared one, for tables that are kept up in steps; it goes when the driver ends."""
    name = f"{folder(spark)}/tidewater-{uuid.uuid4().hex}"
    path, system = _path(spark, name)
    system.mkdirs(path)
    system.deleteOnExit(path)
    return name


def discard(*tables: DataFrame) -> None:
    """Delete tables that written() returned, once nothing that reads them is still to be computed."""
    for table in tables:
        at = _place[table]
        drop(table.sparkSession, at, at + 1)


def reclaim(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are over.

    It does so when the driver collects the garbage that refers to them, which a
    driver with little to do puts off while the disks fill up.  The scheduler holds
    on to the last job, so another one, of one row, goes first.
    """
    gc.collect()
    spark.range(1).count()
    spark._jvm.System.gc()


def mark() -> int:
    """How many tables this process has written so far."""
    return len(_made)


def drop(spark: SparkSession, since: int, until: int) -> None:
    """Delete the tables written between two marks, once nothing that reads them is still to be computed."""
    for i in range(since, min(until, len(_made))):
        if _made[i]:
            path, system = _path(spark, _made[i])
            system.delete(path, True)
            _made[i] = ""
