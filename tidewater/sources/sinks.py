"""Sinks: dated files, tables, and tables that are rewritten as a whole."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_dated(df: DataFrame, path: str, kind: str = "csv", by: str = "dt") -> None:
    """Files in one folder for each day."""
    df.write.mode("append").partitionBy(by).option("header", True).format(kind).save(path)


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(table)


def overwrite(df: DataFrame, table: str) -> None:
    """Replace a table and its schema."""
    df.write.mode("overwrite").format("parquet").option("overwriteSchema", True).saveAsTable(table)


def rewrite(spark: SparkSession, path: str, df: DataFrame) -> str:
    """Write the next version of a table below ``path`` and return its place.

    A reader of the version before is never disturbed, and ``df`` may read it; the
    caller points readers to the new one when this returns.
    """
    place = f"{path.rstrip('/')}/v={uuid.uuid4().hex}"
    df.write.parquet(place)
    return place


def nulls_for_empty(df: DataFrame) -> DataFrame:
    """Empty strings as nulls, as loaders of CSV into a database do."""
    return df.select(*[F.nullif(F.col(f.name), F.lit("")).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name) for f in df.schema.fields])


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Ledger:
    """Numbered JSON records below a folder; the last whole one counts, so a record takes effect at once or not at all."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.folder = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
        self.files = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        if not self.files.exists(self.folder):
            return []
        names = [s.getPath().getName() for s in self.files.listStatus(self.folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _at(self, number: int):
        return self.jvm.org.apache.hadoop.fs.Path(self.folder, f"{number:020d}.json")

    def last(self) -> dict:
        for number in reversed(self._numbers()):
            stream = self.files.open(self._at(number))
            try:
                return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            except ValueError:  # its writer was lost half-way
                continue
            finally:
                stream.close()
        return {}

    def put(self, record: dict) -> None:
        """Write the next record; of two writers at once, one fails."""
        stream = self.files.create(self._at(max(self._numbers(), default=-1) + 1), False)
        stream.write(json.dumps(record).encode())
        stream.close()
