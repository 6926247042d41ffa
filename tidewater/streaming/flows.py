"""Streaming flows.  Each has its own checkpoint, and a rerun picks up only what is new."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.relational import history
from ..sources.files import RESCUED, conform, csv_stream, with_audit
from ..sources.sinks import Ledger, delete_folder


def drain(stream: DataFrame, checkpoint: str, path: str) -> None:
    """Append all that is there to Parquet files, and stop."""
    stream.writeStream.option("checkpointLocation", checkpoint).option("path", path).format("parquet").trigger(availableNow=True).start().awaitTermination()


def ingest(spark: SparkSession, source: str, schema: StructType, system: str, checkpoint: str, path: str, files_per_trigger: int | None = None) -> None:
    """CSV files to a bronze table: typed, with rescued data and audit columns."""
    drain(with_audit(conform(csv_stream(spark, source, schema, files_per_trigger), schema), system), checkpoint, path)


def register(entities: dict[str, StructType], build: Callable[[str, StructType], None]) -> None:
    """One flow for each entity."""
    for name, schema in entities.items():
        build(name, schema)


def split_rescued(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and rows in quarantine for what had to be rescued from them."""
    return df.where(F.col(RESCUED).isNull()), df.where(F.col(RESCUED).isNotNull())


def enrich(stream: DataFrame, static: DataFrame, key: str) -> DataFrame:
    """Stream rows with a static table's columns; one static row for each key, so that rows can't multiply."""
    return stream.join(static.dropDuplicates([key]), key, "left")


class HistoryTable:
    """Slowly changing dimension of type 2, kept by streams: all versions by key and sequence, late ones put in their place.

    A batch is appended as it is; readers put the batches that came since the last
    compaction in place, for the keys that these have.  So a batch costs what it
    holds, and a compaction, due every ``most`` batches, rewrites the ``buckets``
    (of key hashes) that were touched.  A ledger below ``path`` says where
    everything is and which batch of each stream came last: a restarted driver goes
    on from there, a batch that comes again changes nothing, and several streams,
    each with a checkpoint of its own, can feed one table.

    Of rows with the same key and sequence the greatest by the other columns stays,
    however they are cut into batches.  Null keys are a key like any other, a null
    sequence comes first, columns that a batch adds are null in older rows, and
    types that it widens are wider from then on.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], sequence: str, buckets: int = 64, most: int = 8):
        self.spark, self.path, self.keys, self.sequence, self.buckets, self.most = spark, path.rstrip("/"), keys, sequence, buckets, most
        self.ledger = Ledger(spark, f"{self.path}/_ledger")
        own = self.ledger.last().get("buckets", buckets)
        if own != buckets:
            raise ValueError(f"{path} has {own} buckets, not {buckets}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _rows(self, state: dict, places: list[str], versions: bool) -> DataFrame | None:
        """Rows at some places, with the columns that the table has by now."""
        if not places:
            return None
        schema = StructType.fromJson(json.loads(state["schema"]))
        if versions:
            kind = schema[self.sequence].dataType
            schema = StructType([*schema.fields, StructField("__START_AT", kind), StructField("__END_AT", kind)])
        return self.spark.read.schema(schema).parquet(*places)

    def _merged(self, base: DataFrame | None, fresh: DataFrame) -> DataFrame:
        """Versions with fresh rows in place: those of other keys as they are, those of the fresh rows' keys worked out anew."""
        if base is None:
            return history(fresh, self.keys, self.sequence)
        mine = fresh.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]).distinct()
        same = [base[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)]
        again = base.join(mine, same, "left_semi").select(*fresh.columns).unionByName(fresh)
        return base.join(mine, same, "left_anti").unionByName(history(again, self.keys, self.sequence))

    def read(self) -> DataFrame | None:
        """All versions, with __START_AT and __END_AT; None before the first batch."""
        state = self.ledger.last()
        base, fresh = self._rows(state, list(state.get("places", {}).values()), True), self._rows(state, state.get("deltas", []), False)
        return base if fresh is None else self._merged(base, fresh)

    def apply(self, batch: DataFrame, batch_id: int | None = None, stream: str | None = None) -> None:
        """Take up a batch.  ``batch_id`` counts within its ``stream``, whose name may be left out while there is one only."""
        state = self.ledger.last()
        batches = state.get("batches", {})
        if stream is None:
            if batch_id is not None and len(batches) > 1:
                raise ValueError(f"{self.path} has several streams: a batch's number needs its stream's name")
            stream = next(iter(batches), "")
        if batch_id is not None and batch_id <= batches.get(stream, -1):
            return
        place = f"{self.path}/d={uuid.uuid4().hex}"
        batch.write.parquet(place)
        known = batch.schema
        if "schema" in state:
            empty = self.spark.createDataFrame([], StructType.fromJson(json.loads(state["schema"])))
            known = empty.unionByName(self.spark.createDataFrame([], batch.schema), allowMissingColumns=True).schema
        nullable = StructType([StructField(f.name, f.dataType) for f in known.fields])
        told = batches if batch_id is None else batches | {stream: batch_id}
        self.ledger.put(state | {"buckets": self.buckets, "batches": told, "schema": nullable.json(), "deltas": [*state.get("deltas", []), place]})
        if len(state.get("deltas", [])) + 1 >= self.most:
            self.compact()

    def compact(self) -> None:
        """Write the touched buckets anew, with all batches in place.  What they replace stays for readers at work until the next compaction, or :meth:`vacuum`."""
        state = self.ledger.last()
        fresh = self._rows(state, state.get("deltas", []), False)
        if fresh is None:
            return
        places = state.get("places", {})
        touched = [r[0] for r in fresh.select(self._bucket().alias("b")).distinct().collect()]
        out = self._merged(self._rows(state, [places[str(b)] for b in touched if str(b) in places], True), fresh)
        place = f"{self.path}/v={uuid.uuid4().hex}"
        out.withColumn("_bucket", self._bucket()).repartition("_bucket").write.partitionBy("_bucket").parquet(place)
        self.vacuum()
        self.ledger.put(state | {"deltas": [], "places": places | {str(b): f"{place}/_bucket={b}" for b in touched}, "before": [*state["deltas"], *[places[str(b)] for b in touched if str(b) in places]]})

    def vacuum(self) -> None:
        """Delete what compactions have replaced."""
        state = self.ledger.last()
        for old in state.get("before", []):
            delete_folder(self.spark, old)
        if state.get("before"):
            self.ledger.put(state | {"before": []})

    def follow(self, stream: DataFrame, checkpoint: str) -> None:
        """Take up all that a stream has; its checkpoint's place is its name."""
        take = lambda batch, batch_id: self.apply(batch, batch_id, checkpoint)
        stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    def refresh(self, stream: DataFrame, checkpoint: str) -> None:
        """Full refresh: forget all that was read and kept, and follow the stream from its beginning."""
        forget(self.spark, checkpoint)
        self.vacuum()
        state = self.ledger.last()
        self.ledger.put({"before": [*state.get("deltas", []), *state.get("places", {}).values()]})
        self.follow(stream, checkpoint)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a checkpoint or a table's files."""
    delete_folder(spark, path)


def refill(spark: SparkSession, stream: DataFrame, checkpoint: str, path: str) -> None:
    """Full refresh of a drained table: its files and its checkpoint go, and all that is there is read again."""
    forget(spark, checkpoint)
    forget(spark, path)
    drain(stream, checkpoint, path)


def current_stream(stream: DataFrame, table: HistoryTable, checkpoint: str, deleted: Column | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """Slowly changing dimension of type 1 with deletions, kept by a stream: each key's last version, late rows in their place, unless it is a deletion."""
    table.follow(stream, checkpoint)
    rows = table.read().where(F.col("__END_AT").isNull())
    return (rows.where(~F.coalesce(deleted, F.lit(False))) if deleted is not None else rows).drop("__START_AT", "__END_AT", *without)


def windowed_counts(events: DataFrame, time: str = "ts", key: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and key; events later than the watermark are left out.  An extension: the marts need no windows."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    return timed.groupBy(F.window("_t", width), key).count().select(F.col("window.start").alias("start"), key, "count")


def sessions(events: DataFrame, time: str = "ts", key: str = "user_id", gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of a key: events with less than a gap between them."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    return timed.groupBy(F.session_window("_t", gap), key).agg(F.count(F.lit(1)).alias("events")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "events")


def changed_since(df: DataFrame, stamp: str, mark) -> DataFrame:
    """Rows merged after a mark: what an index has still to take up."""
    return df.where(F.col(stamp) > F.lit(mark))
