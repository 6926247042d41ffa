"""CSV files whose columns change: a schema log beside the table, and a stream that stops, takes up the new schema and goes on."""

from __future__ import annotations

import json

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from ..staging import written
from .files import RESCUED, conform, union_all, with_audit
from .sinks import Ledger, delete_folder

#: Types tried for a column, the first that fits all its values.
TRIED = ("bigint", "double", "boolean", "date", "timestamp")
#: What a column's type may become.
WIDER = {"bigint": "double", "date": "timestamp"}


class SchemaChanged(Exception):
    """The stream met columns that its schema doesn't have yet; the log has them now."""


def headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, header) of CSV files: the first line of each."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_n")).where("_at = 0")
    return lines.groupBy("path").agg(F.min_by("value", "_n").alias("header"))


def by_name(spark: SparkSession, paths: list[str], multi_line: bool = False) -> DataFrame:
    """Rows of CSV files as strings with ``_source_file``: columns are told by each file's own header, whatever their order and number; files with the same header are read together."""
    named: dict[str, list[str]] = {}
    for r in headers(spark, paths).collect():  # one row a file that has just landed
        named.setdefault(r["header"], []).append(r["path"])
    frames = []
    for header, files in sorted(named.items()):
        columns = spark.read.option("header", True).csv(files[0]).columns
        schema = StructType([StructField(c, StringType()) for c in columns])
        frames.append(spark.read.schema(schema).option("header", True).option("multiLine", multi_line).csv(files).withColumn("_source_file", F.col("_metadata.file_path")))
    return union_all(frames)


def misfits(rows: DataFrame, columns: list[str]) -> dict[str, dict[str, int]]:
    """How many values of each string column each of the types doesn't fit, in one aggregation; nothing for a column without values."""
    if not columns:
        return {}
    day = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$"  # a cast to a date would drop a time
    wrong = lambda c, t: c.isNotNull() & (c.try_cast(t).isNull() | (~c.rlike(day) if t == "date" else F.lit(False)))
    counts = [F.count_if(wrong(F.col(f"`{c}`"), t)).alias(f"{i}|{t}") for i, c in enumerate(columns) for t in TRIED]
    seen = [F.count(F.col(f"`{c}`")).alias(f"{i}|") for i, c in enumerate(columns)]
    found = rows.agg(*counts, *seen).first()
    return {c: {t: found[f"{i}|{t}"] for t in TRIED} if found[f"{i}|"] else {} for i, c in enumerate(columns)}


def merged(schema: StructType | None, found: dict[str, dict[str, int]]) -> StructType:
    """The schema with new columns at its end, and wider types where these fit more of the new values; what still doesn't fit is left to be rescued.

    A new column gets the first type that fits all its values, else string.
    """
    fields = {f.name: f.dataType.simpleString() for f in schema.fields} if schema else {}
    for name, wrong in found.items():
        if name not in fields:
            fields[name] = next((t for t in TRIED if wrong and not wrong[t]), "string")
        elif (wide := WIDER.get(fields[name])) and wrong and wrong[wide] < wrong[fields[name]]:
            fields[name] = wide
    return StructType([StructField(n, DataType.fromDDL(k)) for n, k in fields.items()])


class EvolvingTable:
    """A table fed by a folder of CSV files, once a file, whose schema follows the files.

    The log keeps every version of the schema, and which version each batch was
    written with.  A batch that brings new columns, or wider numbers or times,
    writes the next version, and is written with it.  With ``stops`` the stream
    stops there, for whoever has to know, and the next start reads the batch again;
    ``ingest`` starts again by itself.  What doesn't fit its column is kept as JSON in
    ``_rescued_data``, so no row and no value is lost.  A batch that comes again
    replaces what it wrote.  ``multi_line`` allows quoted line feeds, at the price of files that can't be split.
    """

    def __init__(self, spark: SparkSession, path: str, system: str, multi_line: bool = False, stops: bool = False):
        self.spark, self.path, self.system, self.multi_line, self.stops = spark, path.rstrip("/"), system, multi_line, stops
        self.log = Ledger(spark, f"{self.path}/_schema")

    def _state(self) -> dict:
        return {"versions": [], "batches": {}} | self.log.last()

    def schema(self, version: int | None = None) -> StructType | None:
        """A version of the schema (from 1), or the last; None before the first file."""
        versions = self._state()["versions"]
        return StructType.fromJson(json.loads(versions[(version or len(versions)) - 1])) if versions else None

    def _take(self, batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]
        if not paths:
            return
        rows = written(by_name(self.spark, paths, self.multi_line))
        state, schema = self._state(), self.schema()
        own = [c for c in rows.columns if not c.startswith("_")]
        after = merged(schema, misfits(rows, own))
        if after != schema:
            state["versions"] = [*state["versions"], after.json()]
            self.log.put(state)
        if after != schema and self.stops:
            raise SchemaChanged(", ".join(sorted({f.simpleString() for f in after.fields} - {f.simpleString() for f in (schema.fields if schema else [])})))
        place = f"{self.path}/batch={number}"
        delete_folder(self.spark, place)
        with_audit(conform(rows, after), self.system, str(number)).write.parquet(place)
        self.log.put(state | {"batches": state["batches"] | {str(number): len(state["versions"])}})

    def ingest(self, source: str, checkpoint: str, files_per_batch: int | None = None, restarts: int = 20) -> int:
        """Take up all files below ``source`` that haven't been; returns how often the stream stopped for a new schema and was started again."""
        for again in range(restarts + 1):
            names = "path string, modificationTime timestamp, length long, content binary"
            reader = self.spark.readStream.format("binaryFile").schema(names).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
            reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
            stream = reader.load(source).select("path")  # only names: contents aren't read
            versions = len(self._state()["versions"])
            try:
                stream.writeStream.foreachBatch(self._take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
                return again
            except PySparkException:
                if len(self._state()["versions"]) == versions:
                    raise
        raise RuntimeError(f"the schema changed more than {restarts} times in one run")

    def read(self) -> DataFrame:
        """All rows, with the last schema: each batch is read with the version that it was written with."""
        state = self._state()
        schema, audit = self.schema(), f"{RESCUED} string, _source_file string, _ingested_at timestamp, _batch_id string, _source_system string"
        if schema is None:
            raise ValueError(f"{self.path} has no schema yet")
        extra = StructType.fromDDL(audit).fields
        frames = []
        for version in sorted(set(state["batches"].values())):
            places = [f"{self.path}/batch={n}" for n, v in state["batches"].items() if v == version]
            rows = self.spark.read.schema(StructType([*self.schema(version).fields, *extra])).parquet(*places)
            have = set(self.schema(version).fieldNames())
            frames.append(rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], *[f.name for f in extra]))
        return union_all(frames) if frames else self.spark.createDataFrame([], StructType([*schema.fields, *extra]))
