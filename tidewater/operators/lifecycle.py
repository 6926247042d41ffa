"""Keeping chunks and their index true to a folder of files: one comparison of all states, and the run that mends them.

A file can be listed in the folder, parsed (its silver chunks stand for some
content hash), dead-lettered, merged into gold, and indexed.  :func:`reconcile`
compares all of these by chunk and file at once and says what every file still
needs; :class:`Lifecycle` does it.  A second run finds nothing left to do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import Ledger
from ..staging import written
from .documents import merge_chunks
from .feed import Consumer, VersionedTable
from .index import ChunkIndex

PARSE, PARSE_AGAIN, RETIRE, PURGE, MERGE, RESTORE, SYNC, NONE = "parse", "parse_again", "retire", "purge", "merge", "restore", "sync", "none"


def text_hash(text: str = "chunk_text"):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def reconcile(listing: DataFrame, silver: DataFrame, failures: DataFrame, gold: DataFrame, index: DataFrame) -> DataFrame:
    """(source_file, action, reason) of every file that any state knows, the first that it needs.

    ``listing`` and ``failures`` have (source_file, content_hash), ``silver``
    (source_file, content_hash, chunk_id, text_hash), ``gold`` (source_file,
    chunk_id, text_hash, contract_id, version, is_current), ``index``
    (source_file, chunk_id, text_hash, is_current).  A file's last parse is what
    silver has of it; a dead letter counts for the content it names.  A file is
    served if it is listed with the content that was parsed; its chunks are
    current if besides no file of the same contract has a later version, even a
    retired one.  Two aggregations, no join: by chunk, then by file.
    """
    null = lambda kind: F.lit(None).cast(kind)

    def state(df: DataFrame | None, side: str, **columns) -> DataFrame:
        kinds = {"source_file": "string", "chunk_id": "string", "content": "string", "text": "string", "contract": "string", "version": "int", "current": "boolean"}
        return df.select(*[columns.get(c, null(k)).cast(k).alias(c) for c, k in kinds.items()], F.lit(side).alias("side"))

    file, chunk = F.col("source_file"), F.col("chunk_id")
    every = state(listing, "listed", source_file=file, content=F.col("content_hash"))
    every = every.unionByName(state(failures, "failed", source_file=file, content=F.col("content_hash")))
    every = every.unionByName(state(silver, "silver", source_file=file, chunk_id=chunk, content=F.col("content_hash"), text=F.col("text_hash")))
    every = every.unionByName(state(gold, "gold", source_file=file, chunk_id=chunk, text=F.col("text_hash"), contract=F.col("contract_id"), version=F.coalesce("version", F.lit(1)), current=F.coalesce("is_current", F.lit(False))))
    every = every.unionByName(state(index, "index", source_file=file, chunk_id=chunk, text=F.col("text_hash"), current=F.coalesce("is_current", F.lit(False))))

    of = lambda side, what: F.max(F.when(F.col("side") == side, F.col(what)))
    has = lambda side: F.max(F.col("side") == side)
    chunks = every.groupBy("source_file", "chunk_id").agg(
        has("silver").alias("in_silver"), has("gold").alias("in_gold"), has("index").alias("in_index"), *[of(s, "text").alias(f"{s}_text") for s in ("silver", "gold", "index")],
        of("gold", "current").alias("gold_current"), of("index", "current").alias("index_current"), of("listed", "content").alias("listed"), of("silver", "content").alias("parsed"),
        F.collect_set(F.when(F.col("side") == "failed", F.col("content"))).alias("failed"), of("gold", "contract").alias("contract"), of("gold", "version").alias("version"),
    )
    missing = F.col("in_silver") & (~F.col("in_gold") | ~F.col("silver_text").eqNullSafe(F.col("gold_text")))
    orphan = F.col("in_gold") & ~F.col("in_silver")
    stale = (F.col("in_gold") != F.col("in_index")) | (F.col("in_gold") & (~F.col("gold_text").eqNullSafe(F.col("index_text")) | (F.col("gold_current") != F.col("index_current"))))
    files = chunks.groupBy("source_file").agg(
        F.max("listed").alias("listed"), F.max("parsed").alias("parsed"), F.flatten(F.collect_list("failed")).alias("failed"), F.max("contract").alias("contract"), F.max("version").alias("version"),
        *[F.count_if(c).alias(n) for n, c in {"in_silver": F.col("in_silver"), "in_gold": F.col("in_gold"), "current": F.col("gold_current"), "retired": ~F.col("gold_current"), "missing": missing, "orphans": orphan, "stale": stale}.items()],
    )
    latest = files.where("contract IS NOT NULL").groupBy(F.col("contract").alias("_contract")).agg(F.max("version").alias("_latest"))
    files = files.join(latest, F.col("contract") == F.col("_contract"), "left")

    listed, parsed, known = F.col("listed").isNotNull(), F.col("listed").eqNullSafe(F.col("parsed")), F.col("parsed").isNotNull() | (F.size("failed") > 0)
    dead = F.array_contains("failed", F.col("listed"))
    superseded = F.coalesce(F.col("version") < F.col("_latest"), F.lit(False))
    served = listed & parsed
    rules = [
        (~listed & (F.col("current") > 0), RETIRE, "file is gone"),
        (listed & ~parsed & dead & (F.col("current") > 0), RETIRE, "new content can't be parsed"),
        (listed & ~parsed & ~dead & known, PARSE_AGAIN, "content changed"),
        (listed & ~parsed & ~dead, PARSE, "new file"),
        (served & (F.col("missing") > 0), MERGE, "chunks not in gold"),
        (served & (F.col("orphans") > 0), PURGE, "chunks no longer in the file"),
        (served & superseded & (F.col("current") > 0), RETIRE, "superseded"),
        (served & ~superseded & (F.col("retired") > 0), RESTORE, "file is back"),
        (F.col("stale") > 0, SYNC, "index differs from gold"),
        (listed & ~parsed & dead, NONE, "dead letter"),
    ]
    action = reason = None
    for hit, name, why in rules:
        action = F.when(hit, name) if action is None else action.when(hit, name)
        reason = F.when(hit, why) if reason is None else reason.when(hit, why)
    return files.select("source_file", action.otherwise(NONE).alias("action"), reason.alias("reason"))


Parser = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


class Lifecycle:
    """Silver, dead letters, gold and an index below one folder, kept true to a listing by ``run``.

    ``parse`` takes (source_file, content_hash, and whatever else the listing
    has) and returns chunks (chunk_id, source_file, chunk_seq, chunk_text,
    contract_id, and more if wished) and dead letters (source_file, error).
    """

    def __init__(self, spark: SparkSession, path: str, parse: Parser, vector: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.path, self.parse = spark, path.rstrip("/"), parse
        self.silver, self.failures, self.gold = (VersionedTable(spark, f"{self.path}/{n}", k) for n, k in (("silver", ["chunk_id"]), ("failures", ["source_file", "content_hash"]), ("gold", ["chunk_id"])))
        self.vector = vector or (lambda df: df.withColumn("embedding", F.lit(None).cast("array<double>")))
        self.index = ChunkIndex(spark, f"{self.path}/index", attributes=("source_file", "text_hash"))
        self.consumer = Consumer(spark, f"{self.path}/_seen", self.gold)
        self.runs = Ledger(spark, f"{self.path}/_runs")

    def _gold(self) -> DataFrame:
        return self.gold.read().withColumn("text_hash", text_hash())

    def states(self, listing: DataFrame) -> DataFrame:
        """What :func:`reconcile` says of the listing (source_file, content_hash) now."""
        empty = lambda schema: self.spark.createDataFrame([], schema)
        silver = self.silver.read().withColumn("text_hash", text_hash()) if self.silver.version else empty("source_file string, content_hash string, chunk_id string, text_hash string")
        failures = self.failures.read() if self.failures.version else empty("source_file string, content_hash string")
        gold = self._gold() if self.gold.version else empty("source_file string, chunk_id string, text_hash string, contract_id string, version int, is_current boolean")
        index = self.index.rows().withColumnsRenamed({"current": "is_current"}) if self.index.version else empty("source_file string, chunk_id string, text_hash string, is_current boolean")
        return reconcile(listing, silver, failures, gold, index)

    def run(self, listing: DataFrame) -> dict[str, int]:
        """Parse, merge, retire and sync what the listing asks for; returns how many files needed what at the start."""
        plan = written(self.states(listing))
        needed = {r["action"]: r["count"] for r in plan.groupBy("action").count().collect()}
        if set(needed) - {NONE}:
            self._parse(listing, plan)
            self._merge(listing)
            self.consumer.poll(lambda feed, version: self.index.sync(self.vector(feed.withColumn("text_hash", text_hash())), version))
        self.runs.put({"needed": needed})
        return needed

    def _parse(self, listing: DataFrame, plan: DataFrame) -> None:
        todo = listing.join(plan.where(F.col("action").isin(PARSE, PARSE_AGAIN)).select("source_file"), "source_file", "left_semi")
        todo = written(todo)
        if todo.isEmpty():
            return
        chunks, bad = self.parse(todo)
        hashes = todo.select("source_file", "content_hash")
        fresh, dead = chunks.join(hashes, "source_file"), bad.select("source_file", "error").join(hashes, "source_file")
        if self.silver.version:
            # a file that can't be parsed any more keeps its last good chunks in silver; they aren't served
            again = hashes.join(bad.select("source_file"), "source_file", "left_anti")
            fresh = self.silver.read().join(again.select("source_file"), "source_file", "left_anti").unionByName(fresh, allowMissingColumns=True)
        if self.failures.version:
            dead = self.failures.read().unionByName(dead)
        self.silver.write(fresh)
        self.failures.write(dead)

    def _merge(self, listing: DataFrame) -> None:
        silver = self.silver.read()
        served = silver.join(listing.select("source_file", "content_hash"), ["source_file", "content_hash"], "left_semi")
        columns = [c for c in silver.columns if c != "content_hash"]
        staged = served.select(*columns).withColumn("version", F.lit(None).cast("int")).withColumn("is_current", F.lit(True))
        before = self.gold.read() if self.gold.version else self.spark.createDataFrame([], staged.schema)
        after = written(merge_chunks(before, staged))
        latest = after.where("contract_id IS NOT NULL").groupBy(F.col("contract_id").alias("_c")).agg(F.max("version").alias("_latest"))
        here = served.select(F.col("source_file").alias("_f")).distinct().withColumn("_here", F.lit(True))
        after = after.join(latest, F.col("contract_id") == F.col("_c"), "left").join(here, F.col("source_file") == F.col("_f"), "left")
        current = F.col("_here").isNotNull() & (F.col("_latest").isNull() | (F.col("version") >= F.col("_latest")))
        self.gold.write(after.withColumn("is_current", current).select(*before.columns))
