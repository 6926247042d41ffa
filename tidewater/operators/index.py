"""A stored search index over chunks: postings by term and vectors by cell, kept up by a change feed.

A search reads only the buckets of its words, or the cells nearest to its vector,
instead of all texts and vectors.  Every sync writes one segment with what its
feed brings (postings, vectors, lengths) and the keys that it replaces or
deletes; an entry counts while no later segment has its key.  A ledger names the
segments and the version of the source they stand for, so that a sync takes
effect at once, a repeated one changes nothing, and a stopped one leaves nothing
that is read.  ``compact`` makes one segment of all.

Cells come from k-means (cosine distance) on a bounded sample of the first
vectors; every vector is in the cell of its centre, and how many cells a search
reads is measured when the index is made: as many as find ``recall`` of the true
neighbours of sampled vectors.  ``exact`` searches read all cells.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import Ledger, delete_folder
from ..staging import discard, reclaim, written
from .feed import AFTER, BEFORE, CHANGE, DELETE, INSERT, VERSION
from .search import asked_words, bm25, enough, fuse, ranks_among, top
from .vectors import cosines, nearest, unit

#: Segments before a sync compacts them.
MOST_SEGMENTS = 12
#: Vectors that cells are fitted on for each cell, and questions by which the number of cells to read is measured.
SAMPLE_A_CELL, QUESTIONS = 64, 100


#: What a word's posting row holds of the rows that have it: their keys and marks.  A mark has a row's length in words, how often it has the word, and whether it is current.
ENTRIES = "keys array<{k}>, marks array<bigint>"

#: Bytes in lower case, and those that words are made of.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8))


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of a batch's texts as search.words() has them, the number of each word's row, and how many words every row has."""
    for letter, lower in (("\u212a", "k"), ("\u0130", "i\u0307")):  # the only letters beyond ASCII whose lower case has a letter of words
        texts = pc.replace_substring(texts.cast(pa.large_string()), letter, lower)
    _, cuts, data = texts.buffers()
    cuts = np.frombuffer(cuts, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    own = _LOWER[np.frombuffer(data or b"", np.uint8)[cuts[0] : cuts[-1]]]
    cuts = cuts - cuts[0]
    inside = _IN_WORD[own]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = cuts[:-1][cuts[:-1] < len(own)]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    row = np.searchsorted(cuts, starts, "right") - 1
    ends = np.r_[np.flatnonzero(begins[inside]), np.count_nonzero(inside)].astype(np.int64)
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(own[inside]))
    return found, row, np.bincount(row, minlength=len(texts))


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, length, ...) of (key, text, ...)."""
    for b in batches:
        if b.num_rows:
            length = pa.array(_words(b.column(1))[2].astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), length, *b.columns[2:]], names=[b.schema.names[0], "length", *b.schema.names[2:]])


def _told(entries: DataFrame) -> DataFrame:
    """Entries with what their marks say."""
    mark = F.col("mark")
    return entries.withColumns({"length": F.shiftright(mark, 32).cast("int"), "count": F.shiftright(mark.bitwiseAND((1 << 32) - 1), 1).cast("int"), "current": mark.bitwiseAND(1) == 1})


def _lists(cuts: np.ndarray, *values: pa.Array) -> list[pa.ListArray]:
    return [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), v) for v in values]


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, keys, marks) of (key, text, current): a row for each term of a batch, so that what is shuffled is entries, not words."""
    for b in batches:
        if not b.num_rows:
            continue
        found, row, length = _words(b.column(1))
        if not len(found):
            continue
        coded = found.dictionary_encode()
        both, count = np.unique(coded.indices.to_numpy().astype(np.int64) * b.num_rows + row, return_counts=True)
        term, row = np.divmod(both, b.num_rows)
        current = b.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        marks = pa.array((length[row].astype(np.int64) << 32) | (count << 1) | current[row])
        cuts = np.searchsorted(term, np.arange(len(coded.dictionary) + 1))
        yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), *_lists(cuts, b.column(0).take(pa.array(row)), marks)], names=["term", "keys", "marks"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_bucket, term, keys, marks) of single entries sorted by bucket and term; a term's run ends with its batch, so no row grows without bound."""
    for b in batches:
        if b.num_rows:
            term = np.array(b.column(1).to_pylist(), object)
            starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
            at = pa.array(starts)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *_lists(np.r_[starts, b.num_rows], b.column(2), b.column(3))], names=["_bucket", "term", "keys", "marks"])


@dataclass
class Reading:
    """What a search reads, against the size of all of its kind."""

    bytes: int
    of: int


class ChunkIndex:
    """Keyword, vector and hybrid search over ``key``, ``text`` and ``vector`` columns of a table whose ``current`` flag (if it has one) is true, unless a search asks for all.

    ``attributes`` are columns kept for a search's ``where``.  Rows with a null
    text or vector are found by the other; a null flag counts as not current.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "chunk_id", text: str = "chunk_text", vector: str = "embedding", current: str | None = "is_current", attributes: tuple[str, ...] = (), buckets: int = 64, cells: int = 64, recall: float = 0.95):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.text, self.vector, self.current, self.attributes = key, text, vector, current, attributes
        self.buckets, self.cells, self.recall = buckets, cells, recall
        self.ledger = Ledger(spark, f"{self.path}/_ledger")

    # Writing.

    @property
    def version(self) -> int:
        """The source's version that the index stands for; 0 before the first sync."""
        return self.ledger.last().get("version", 0)

    def sync(self, feed: DataFrame, version: int) -> None:
        """Take up the changes that lead to a version of the source; one that the index has already changes nothing.

        The feed is read once each for lengths, words, vectors and the keys that go: its texts are not written once more.
        """
        state = self.ledger.last()
        if version <= state.get("version", 0):
            return
        columns = dict.fromkeys([self.key, self.text, self.vector, *([self.current] if self.current else []), *self.attributes, CHANGE])
        own = feed.select(*columns)
        added = own.where(F.col(CHANGE).isin(INSERT, AFTER)).drop(CHANGE)
        gone = own.where(F.col(CHANGE).isin(BEFORE, DELETE)).select(F.col(self.key).alias("key"))
        segments = state.get("segments", [])
        self._put(state, added, gone, segments, version)
        reclaim(self.spark)  # what was shuffled for the segment
        if len(segments) + 1 > MOST_SEGMENTS:
            self.compact()

    def _put(self, state: dict, added: DataFrame, gone: DataFrame, before: list[dict], version: int) -> None:
        flag = F.coalesce(F.col(self.current), F.lit(False)) if self.current else F.lit(True)
        rows = added.select(F.col(self.key).alias("key"), F.coalesce(F.col(self.text), F.lit("")).alias("_t"), F.col(self.vector).cast("array<double>").alias("vector"), flag.alias("current"), *[F.col(a).alias(f"a_{a}") for a in self.attributes])
        place = f"{self.path}/s={uuid.uuid4().hex}"
        counted = rows.select("key", "_t", "current", *[f"a_{a}" for a in self.attributes])
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema.fields[2:])
        kind = rows.schema["key"].dataType.simpleString()
        counted.mapInArrow(_lengths, f"key {kind}, length int, {kept}").write.option("compression", "zstd").parquet(f"{place}/rows")
        gone.distinct().write.parquet(f"{place}/gone")
        terms = rows.select("key", "_t", "current").mapInArrow(_postings, f"term string, {ENTRIES.format(k=kind)}").withColumn("_bucket", self._bucket(F.col("term")))
        terms = terms.repartition("_bucket", F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(4))).sortWithinPartitions("_bucket", "term")
        terms.write.option("compression", "zstd").partitionBy("_bucket").parquet(f"{place}/postings")
        vectors = written(rows.where("vector is not null").select("key", "current", "vector"))
        state = state | self._fitted(state, vectors)
        self._deal(self._placed(state, vectors), "_cell", "key").write.option("compression", "zstd").partitionBy("_cell").parquet(f"{place}/vectors")
        discard(vectors)
        record = {k: state[k] for k in ("model", "centres", "probes") if k in state} | {"version": version}
        record["segments"] = [*before, {"place": place, "number": max((s["number"] for s in before), default=0) + 1}]
        self.ledger.put(record | {"totals": self._totals(record["segments"])})

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _deal(self, df: DataFrame, part: str, order: str) -> DataFrame:
        """A few files a partition, each sorted, so that a common word's postings or a crowded cell are no one task's work."""
        return df.repartition(part, F.pmod(F.xxhash64("key"), F.lit(4))).sortWithinPartitions(part, order)

    def _fitted(self, state: dict, vectors: DataFrame) -> dict:
        """The model of the cells, fitted when vectors come for the first time, and how many of them to read."""
        if "model" in state or (n := vectors.count()) == 0:
            return {}
        usable = vectors.where(F.exists("vector", lambda x: x != 0) & F.forall("vector", lambda x: x.isNotNull()))
        drawn = lambda most, seed: usable.where(F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) < min(1.0, most / n) * (1 << 30))
        sample = written(drawn(SAMPLE_A_CELL * self.cells, 1).select("key", "vector", array_to_vector("vector").alias("features")))
        many = sample.count()
        k = min(self.cells, many // 8)
        if k < 2:
            return {}
        model = KMeans(k=k, distanceMeasure="cosine", seed=1, maxIter=15).fit(sample)
        place = f"{self.path}/m={uuid.uuid4().hex}"
        model.save(place)
        found = {"model": place, "centres": [c.tolist() for c in model.clusterCenters()], "probes": k}
        asked = written(drawn(QUESTIONS, 2).select("key", "vector"))
        placed = self._placed(found, vectors).select("key", "_cell")
        near = nearest(asked.select(F.col("key").alias("asked"), "vector"), vectors, "asked", "key", "vector", 10).join(placed, "key").groupBy("asked").agg(F.collect_list("_cell").alias("cells"))
        order = {r["key"]: self._order(found, r["vector"]) for r in asked.collect()}  # QUESTIONS rows or so
        depths = sorted(order[r["asked"]].index(c) + 1 if c >= 0 else 0 for r in near.collect() for c in r["cells"])
        if depths:
            found["probes"] = max(1, depths[math.ceil(self.recall * len(depths)) - 1])
        return found

    def _placed(self, state: dict, vectors: DataFrame) -> DataFrame:
        """Vectors with their ``_cell``; -1 for those that have no direction, and without a model."""
        odd = F.lit(True) if "model" not in state else ~(F.exists("vector", lambda x: x != 0) & F.forall("vector", lambda x: x.isNotNull()) & (F.size("vector") == len(state["centres"][0])))
        loose = vectors.where(odd).withColumn("_cell", F.lit(-1))
        if "model" not in state:
            return loose
        model = KMeansModel.load(state["model"]).setFeaturesCol("features").setPredictionCol("_cell")
        return model.transform(vectors.where(~odd).withColumn("features", array_to_vector("vector"))).select("key", "current", "vector", "_cell").unionByName(loose)

    def compact(self) -> None:
        """One segment of all that counts; the old ones' files go."""
        state = self.ledger.last()
        old = state.get("segments", [])
        if len(old) < 2:
            return
        place = f"{self.path}/s={uuid.uuid4().hex}"
        self._live("rows", old).write.option("compression", "zstd").parquet(f"{place}/rows")
        entries = self._deal(self._live("postings", old), "_bucket", "term").select("_bucket", "term", "key", "mark")
        kind = entries.schema["key"].dataType.simpleString()
        entries.mapInArrow(_gathered, f"_bucket int, term string, {ENTRIES.format(k=kind)}").write.option("compression", "zstd").partitionBy("_bucket").parquet(f"{place}/postings")
        self._deal(self._live("vectors", old), "_cell", "key").write.option("compression", "zstd").partitionBy("_cell").parquet(f"{place}/vectors")
        self.spark.read.parquet(f"{old[0]['place']}/gone").limit(0).write.parquet(f"{place}/gone")
        self.ledger.put(state | {"segments": [{"place": place, "number": 1}]})
        for s in old:
            delete_folder(self.spark, s["place"])

    # Reading.

    def _table(self, kind: str, segment: dict) -> DataFrame:
        """A segment's table; the parts of one that has none are an empty table."""
        schema = {"postings": f"term string, {ENTRIES}, _bucket int", "vectors": "key {k}, current boolean, vector array<double>, _cell int"}.get(kind)
        if schema is None:
            return self.spark.read.parquet(f"{segment['place']}/{kind}")
        rows = self.spark.read.parquet(f"{segment['place']}/rows")
        return self.spark.read.schema(schema.format(k=rows.schema["key"].dataType.simpleString())).parquet(f"{segment['place']}/{kind}")

    def _live(self, kind: str, segments: list[dict] | None = None, where: Column | None = None) -> DataFrame:
        """Entries that no later segment replaces or deletes; ``where`` prunes parts before."""
        segments = self.ledger.last().get("segments", []) if segments is None else segments
        if not segments:
            raise ValueError(f"{self.path} has never been synced")
        entries = gone = None
        for s in segments:
            own = self._table(kind, s)
            own = own if where is None else own.where(where)
            own = own.select("_bucket", "term", F.inline(F.arrays_zip("keys", "marks")).alias("key", "mark")) if kind == "postings" else own
            own = own.withColumn("_s", F.lit(s["number"]))
            entries = own if entries is None else entries.unionByName(own)
            if s["number"] > segments[0]["number"]:
                out = self._table("gone", s).select(F.col("key").alias("_gone"), F.lit(s["number"]).alias("_until"))
                gone = out if gone is None else gone.unionByName(out)
        if gone is not None:
            last = gone.groupBy("_gone").agg(F.max("_until").alias("_until"))
            entries = entries.join(last, (F.col("key") == F.col("_gone")) & (F.col("_s") < F.col("_until")), "left_anti")
        return entries.drop("_s")

    def _totals(self, segments: list[dict]) -> dict:
        """Rows and words, of all and of current rows: what BM25 needs besides a query's postings."""
        r = self._live("rows", segments).agg(*[f(x).alias(f"{n}_{p}") for p, hit in (("all", F.lit(True)), ("current", F.col("current"))) for n, f, x in (("n", F.count_if, hit), ("words", F.sum, F.when(hit, F.col("length"))))]).first()
        return {p: [r[f"n_{p}"], r[f"words_{p}"] or 0] for p in ("all", "current")}

    def rows(self) -> DataFrame:
        """(key, length, current, attributes) of all rows that the index stands for."""
        named = {f"a_{a}": a for a in self.attributes}
        return self._live("rows").withColumnsRenamed(named | {"key": self.key})

    def _chosen(self, only_current: bool, where: Column | None) -> DataFrame | None:
        """Keys that a search is limited to by attributes; None if it isn't."""
        if where is None:
            return None
        rows = self.rows()
        return (rows.where("current") if only_current else rows).where(where)

    def _counted(self, query: str, only_current: bool, chosen: DataFrame | None) -> tuple[DataFrame, int]:
        """(key, _n, _f0, _f1, ...) of rows with any of the query's words."""
        asked = asked_words(query)
        if not asked:
            return self._live("rows").where(F.lit(False)).select(F.col("key").alias(self.key), F.col("length").alias("_n")), 0
        found = _told(self._live("postings", where=F.col("term").isin(asked) & F.col("_bucket").isin(self._buckets_of(asked))))
        found = found.where("current") if only_current else found
        if chosen is not None:
            found = found.join(chosen.select(F.col(self.key).alias("_k")), F.col("key") == F.col("_k"), "left_semi")
        counts = [F.coalesce(F.max(F.when(F.col("term") == w, F.col("count"))), F.lit(0)).alias(f"_f{i}") for i, w in enumerate(asked)]
        return written(found.groupBy(F.col("key").alias(self.key)).agg(F.max("length").alias("_n"), *counts)), len(asked)

    def _buckets_of(self, asked: list[str]) -> list[int]:
        rows = self.spark.createDataFrame([(w,) for w in asked], "term string").select(self._bucket(F.col("term")).alias("b"))
        return sorted({r["b"] for r in rows.collect()})

    def _scored(self, query: str, only_current: bool, where: Column | None) -> DataFrame:
        chosen = self._chosen(only_current, where)
        counted, asked = self._counted(query, only_current, chosen)
        if chosen is None:
            n, total = self.ledger.last()["totals"]["current" if only_current else "all"]
        else:
            n, total = chosen.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        score, hit = bm25(counted, asked, n, total / n if n else 0.0)
        return counted.where(hit).select(self.key, F.round(score, 6).alias("score"))

    def keyword(self, query: str, k: int = 5, only_current: bool = True, where: Column | None = None) -> DataFrame:
        """The k best by Okapi BM25: the same as a scan of all texts gives."""
        return top(self._scored(query, only_current, where), F.col("score"), self.key, k).select(self.key, "score", "rank")

    def _order(self, state: dict, vector: list[float]) -> list[int]:
        """Cells by the similarity of their centre, best first."""
        near = unit(np.array(state["centres"], float)) @ unit(np.array(vector, float))
        return np.argsort(-near, kind="stable").tolist()

    def _cells(self, vector: list[float], exact: bool, probes: int | None) -> list[int] | None:
        """The cells that a search reads; None for all."""
        state = self.ledger.last()
        if exact or "model" not in state or len(vector) != len(state["centres"][0]):
            return None
        return [-1, *self._order(state, vector)[: probes or state["probes"]]]

    def _similar(self, vector: list[float], only_current: bool, where: Column | None, exact: bool, probes: int | None) -> DataFrame:
        cells = self._cells(vector, exact, probes)
        found = self._live("vectors", where=None if cells is None else F.col("_cell").isin(cells))
        found = found.where("current") if only_current else found
        if (chosen := self._chosen(only_current, where)) is not None:
            found = found.join(chosen.select(F.col(self.key).alias("_k")), F.col("key") == F.col("_k"), "left_semi")
        return cosines(found, vector, "key", "vector").select(F.col("key").alias(self.key), F.round("score", 6).alias("score"))

    def similar(self, vector: list[float], k: int = 5, only_current: bool = True, where: Column | None = None, exact: bool = False, probes: int | None = None) -> DataFrame:
        """The k most similar rows among the nearest cells, or with ``exact`` among all."""
        return top(self._similar(vector, only_current, where, exact, probes), F.col("score"), self.key, k).select(self.key, "score", "rank")

    def hybrid(self, vector: list[float], text: str, k: int = 5, only_current: bool = True, where: Column | None = None, exact: bool = False, probes: int | None = None) -> DataFrame:
        """The k best by reciprocal rank fusion of both whole rankings; that by similarity is of the nearest cells unless ``exact``."""
        lists = [written(self._similar(vector, only_current, where, exact, probes)), written(self._scored(text, only_current, where))]
        best = [one.orderBy(F.desc("score"), self.key).limit(enough(len(lists), k)).select(self.key) for one in lists]
        wanted = written(best[0].unionByName(best[1]).distinct())
        return fuse([ranks_among(one, wanted, self.key) for one in lists], self.key, k)

    def reading(self, text: str | None = None, vector: list[float] | None = None) -> Reading:
        """The bytes of postings or vectors that such a search reads, and of all of them."""
        kind, part = ("postings", "_bucket") if text is not None else ("vectors", "_cell")
        parts = self._buckets_of(asked_words(text)) if text is not None else self._cells(vector, False, None)
        size = read = 0
        for s in self.ledger.last().get("segments", []):
            at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{s['place']}/{kind}")
            files = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for status in files.listStatus(at):
                own = files.getContentSummary(status.getPath()).getLength()
                size += own
                read += own if parts is None or status.getPath().getName() in {f"{part}={p}" for p in parts} else 0
        return Reading(read, size)
