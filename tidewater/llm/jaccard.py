"""Similarity join on word n-grams: exact Jaccard links, with Bayesian pruning of candidates.

1. Every document becomes the set of its shingles (``words`` consecutive words;
   a shorter document is one shingle) and a MinHash signature of bytes.  Documents
   with equal sets are one *class* from here on.
2. Classes that share a band of the signature are candidates.  At similarity 0.8 a
   pair shares none of 32 bands of 5 values with probability 3e-6.  A pair that
   shares several bands belongs to the first of them, so each is worked on once, and
   buckets need neither be joined nor their pairs be written down.
3. A bucket is split into blocks of about ``block`` classes, and each pair of blocks
   is one task's work.  Signatures are compared a few values at a time; a pair goes
   as soon as the posterior probability of reaching the threshold, given its matches
   so far (uniform prior), falls below ``tolerance``.  All looks together drop a pair
   at similarity 0.8 with probability 1.1e-6 at most (different values that share
   their byte only keep pairs in).  A task returns the classes that have pairs left.
4. Only these get their texts, and what is left is verified exactly on the sets.  A
   task returns no pairs: it returns each class's number of links and the least class
   it is linked to through others.  These make the groups.

All work is in proportion to the documents and to the pairs that share a band,
however long the chains are that these form.

Words are runs of other than white space, A-Z lower-cased.  Null and empty texts
have no shingles, no links and a group of their own, and so has a row without a
doc_id (its group is null).  Rows that repeat a doc_id and its text count as
copies; different texts must not share a doc_id.  An empty table gives an empty
result, and columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import reclaim, written
from .components import connected_components, join_hot
from .suffix import _whole_groups
from .textbuf import BASE, LOWER, NOT_SPACE, U64, blocks, chunk_word_hashes, flat, mix64, tidy

VALUES, BAND = 160, 5
#: Signature values compared before each look at the posterior.
CHUNK = 16
#: Buckets are dealt to a task for so many classes, up to so many tasks: their rows are few, their work is not.
CLASSES_A_TASK, MOST_TASKS = 4000, 50_000

_r = np.random.default_rng(20240229)
_A = _r.integers(1, 1 << 63, VALUES, dtype=np.uint64) | U64(1)
_B = _r.integers(0, 1 << 63, VALUES, dtype=np.uint64)


def shingles(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted by row and hash, and the row bounds."""
    buf, offs = flat(column)
    _, _, rows, h = chunk_word_hashes(LOWER[buf], offs, NOT_SPACE)
    n = len(column)
    count = np.bincount(rows, minlength=n)
    base = np.cumsum(count) - count
    size = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
    row = np.repeat(np.arange(n), size)
    at = base[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros(len(row), np.uint64)
    for i in range(words):
        real = at + i < (base + count)[row]
        out = out * U64(BASE) + np.where(real, h[np.minimum(at + i, max(len(h) - 1, 0))] if len(h) else 0, U64(0))
    out = mix64(out)
    order = np.lexsort((out, row))
    out, row = out[order], row[order]
    fresh = np.r_[True, (out[1:] != out[:-1]) | (row[1:] != row[:-1])] if len(out) else np.zeros(0, bool)
    out, row = out[fresh], row[fresh]
    return out, np.searchsorted(row, np.arange(n + 1))


def signatures(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values (row, VALUES) of sets that aren't empty; zeros for empty ones."""
    full = np.flatnonzero(np.diff(bounds) > 0)
    out = np.zeros((len(bounds) - 1, VALUES), np.uint32)
    if len(full):
        starts = bounds[:-1][full]
        for k in range(VALUES):
            out[full, k] = np.minimum.reduceat(((sets * _A[k] + _B[k]) >> U64(32)).astype(np.uint32), starts)
    return out


def _sum_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.r_[U64(0), np.cumsum(values)].astype(np.uint64)
    return sums[bounds[1:]] - sums[bounds[:-1]]


SIGNED = "doc_id long, n int, s1 long, s2 long, signature binary"


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 1 << 20):
            sets, bounds = shingles(block.column(1), words)
            values = signatures(sets, bounds)
            raw = values.astype(np.uint8).tobytes()  # the low bytes
            signature = pa.array([raw[i : i + VALUES] for i in range(0, len(raw), VALUES)], pa.binary())
            s1, s2 = (_sum_by_row(mix64(sets ^ U64(x)), bounds).view(np.int64) for x in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(np.diff(bounds).astype(np.int32)), pa.array(s1), pa.array(s2), signature], names=["doc_id", "n", "s1", "s2", "signature"])

    return run


def _signature_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, VALUES)


def band_keys(values: np.ndarray) -> np.ndarray:
    """(row, band) keys of byte signatures; keys are equal if and only if all values in the same band are."""
    bands = values.reshape(len(values), -1, BAND).astype(np.uint64)
    h = np.zeros(bands.shape[:2], np.uint64) + np.arange(bands.shape[1], dtype=np.uint64)
    for i in range(BAND):
        h = h << U64(8) | bands[:, :, i]
    return mix64(h).view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            keys = band_keys(_signature_matrix(b.column(1)))
            n, k = keys.shape
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.tile(np.arange(k, dtype=np.int8), n)), pa.array(np.repeat(b.column(0).to_numpy(), k))], names=["band", "nth", "cls"])


@cache
def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest matches among n compared values with which P(similarity >= threshold) is at least ``tolerance``.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1); its mass above
    the threshold is the chance of at most m successes in n + 1 trials.
    """
    mass = 0.0
    for m in range(n + 1):
        mass += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if mass >= tolerance:
            return m
    return n


def _sides(keys: np.ndarray, nth: int, left: np.ndarray, right: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Lists whose products hold all pairs of ``left`` and ``right`` that share no band before ``nth``, without those within the band that most of both share."""
    best, most = 0, None
    for c in range(nth):
        own, where = np.unique(keys[:, c], return_inverse=True)
        n = np.bincount(where[left], minlength=len(own)) * np.bincount(where[right], minlength=len(own))
        if n.max() > best:
            best, most = int(n.max()), where == int(n.argmax())
    if most is None:
        return [(left, right)]
    return [(left[~most[left]], right), (left[most[left]], right[~most[right]])]


def _survivors(values: np.ndarray, keys: np.ndarray, nth: int, left: np.ndarray, right: np.ndarray, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of the first index list with the second, which is the same or shares none) that share no band before ``nth`` and that the incremental comparison doesn't drop."""
    first = values[:, :CHUNK]
    i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    within = left is right
    for some, others in _sides(keys, nth, left, right):
        for a in range(0, len(some), 64):
            part = some[a : a + 64]
            same = (first[part][:, None, :] == first[others][None, :, :]).sum(axis=2, dtype=np.int16)
            x, y = np.nonzero(same >= least_matches(CHUNK, threshold, tolerance))
            x, y = part[x], others[y]
            if within:
                x, y = np.minimum(x, y), np.maximum(x, y)
                stay = x < y
                x, y = x[stay], y[stay]
            if nth:
                stay = np.concatenate([(keys[x[z : z + 65536], :nth] != keys[y[z : z + 65536], :nth]).all(axis=1) for z in range(0, len(x), 65536)] or [np.zeros(0, bool)])
                x, y = x[stay], y[stay]
            i.append(x)
            j.append(y)
    i, j = np.concatenate(i), np.concatenate(j)
    if within and len(i):  # both of a pair can be on the first list
        code = np.unique(i * len(values) + j)
        i, j = code // len(values), code % len(values)
    matches = np.zeros(len(i), np.int32)
    for at in range(0, VALUES, CHUNK):
        for part in range(0, len(i), 65536):
            z = slice(part, part + 65536)
            matches[z] += (values[i[z], at : at + CHUNK] == values[j[z], at : at + CHUNK]).sum(axis=1, dtype=np.int32)
        stay = matches >= least_matches(at + CHUNK, threshold, tolerance)
        i, j, matches = i[stay], j[stay], matches[stay]
    return i, j


def _shared(sets: np.ndarray, bounds: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets."""
    if len(i) < 1000:
        return np.array([len(np.intersect1d(sets[bounds[a] : bounds[a + 1]], sets[bounds[b] : bounds[b + 1]], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    docs = np.unique(np.r_[i, j])
    size = np.diff(bounds)[docs]
    owner = np.repeat(np.arange(len(docs)), size)
    place = np.repeat(bounds[docs], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    _, number, often = np.unique(sets[place], return_inverse=True, return_counts=True)
    common = np.cumsum(often > 1) - 1
    keep = often[number] > 1
    owner, number = owner[keep], common[number[keep]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    both = np.zeros((len(docs), len(docs)), np.float32)
    columns = int(number[-1]) + 1 if len(number) else 0
    for at in range(0, columns, 2048):
        lo, hi = np.searchsorted(number, [at, at + 2048])
        x = np.zeros((len(docs), 2048), np.float32)
        x[owner[lo:hi], number[lo:hi] - at] = 1
        both += x @ x.T
    a, b = np.searchsorted(docs, i), np.searchsorted(docs, j)
    return np.rint(both[a, b]).astype(np.int64)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index linked to each, through any others."""
    root = np.arange(n)
    while len(i):
        least = root.copy()
        np.minimum.at(least, i, root[j])
        np.minimum.at(least, j, root[i])
        least = least[least]
        if np.array_equal(least, root):
            break
        root = least
    return root


def _tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, int, np.ndarray, np.ndarray]]:
    """Each task's rows (task, nth, cls, side, signature first), one for each class, with signatures, band keys, the band and the two index lists."""
    for table in _whole_groups(batches, 0, 512):
        task = table.column(0).to_numpy()
        edges = np.flatnonzero(np.r_[True, task[1:] != task[:-1], True])
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            part = table.slice(lo, hi - lo)
            cls, at = np.unique(part.column(2).to_numpy(), return_index=True)
            if len(cls) < 2:
                continue
            part = part.take(pa.array(at)).combine_chunks()
            side = part.column(3).to_numpy()
            values = _signature_matrix(part.column(4))
            # side 0: one block with itself; 1 and 2: two blocks
            left, right = np.flatnonzero(side < 2), np.flatnonzero(side == 2)
            yield part, values, band_keys(values), int(part.column(1)[0].as_py()), left, left if side[0] == 0 else right


def _prune(threshold: float, tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values, keys, nth, left, right in _tasks(batches):
            i, j = _survivors(values, keys, nth, left, right, threshold, tolerance)
            if len(i):
                yield part.select(range(5)).take(pa.array(np.unique(np.r_[i, j]))).combine_chunks().to_batches()[0]

    return run


def _verify(words: int, threshold: float, tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values, keys, nth, left, right in _tasks(batches):
            i, j = _survivors(values, keys, nth, left, right, threshold, tolerance)
            cls, copies = part.column(2).to_numpy(), part.column(5).to_numpy()
            sets, bounds = shingles(part.column(6).combine_chunks(), words)
            size = np.diff(bounds)
            shared = _shared(sets, bounds, i, j)
            link = shared >= threshold * (size[i] + size[j] - shared) - 1e-9
            i, j = i[link], j[link]
            if not len(i):
                continue
            links = np.bincount(i, copies[j], len(cls)) + np.bincount(j, copies[i], len(cls))
            root = _roots(len(cls), i, j)
            has = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays([pa.array(cls[has]), pa.array(links[has].astype(np.int64)), pa.array(cls[root[has]])], names=["cls", "links", "root"])

    return run


PAIRED = "task long, nth tinyint, cls long, side int, signature binary"


def link_documents(docs: DataFrame, words: int = 5, threshold: float = 0.8, tolerance: float = 1e-7, block: int = 256) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies, n_shingles) of every row of ``docs`` (doc_id, text).

    ``class_id`` is the least doc_id of the group of documents that links
    connect; ``n_links`` the number of other documents whose Jaccard similarity
    to this one is at least ``threshold``, copies included; ``n_copies`` how many
    of them have the same set of shingles.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(docs.mapInArrow(tidy(_sign(words)), SIGNED))
    real = signed.where("n > 0 and doc_id is not null")
    classes = real.groupBy("s1", "s2").agg(F.min("doc_id").alias("cls"), F.count(F.lit(1)).alias("copies"), F.max("signature").alias("signature"))
    classes = written(classes)

    count = classes.count()
    tasks = min(max(count // CLASSES_A_TASK, docs.sparkSession.sparkContext.defaultParallelism), MOST_TASKS)

    bands = classes.select("cls", "signature").mapInArrow(tidy(_bands), "band long, nth tinyint, cls long")
    buckets = bands.groupBy("band").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").withColumn("blocks", F.ceil(F.col("rows") / block).cast("int"))
    members = join_hot(bands, buckets, "band", "rows", count * (VALUES // BAND))
    members = members.join(classes.select("cls", "signature"), "cls").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(lo == hi, 0).when(F.col("own") == lo, 1).otherwise(2)
    dealt = dealt.select(F.xxhash64("band", lo, hi).alias("task"), "nth", "cls", side.alias("side"), "signature")
    left = written(dealt.repartition(tasks, "task").sortWithinPartitions("task").mapInArrow(tidy(_prune(threshold, tolerance)), PAIRED))
    reclaim(docs.sparkSession)

    # the texts of classes with pairs left, once each, then to their tasks
    needed = left.select("cls").distinct().withColumnRenamed("cls", "_cls")
    texts = docs.join(needed.hint("shuffle_hash"), docs["doc_id"] == needed["_cls"]).select("doc_id", "text")
    whole = left.join(classes.select("cls", "copies"), "cls").join(texts, F.col("cls") == F.col("doc_id")).select("task", "nth", "cls", "side", "signature", "copies", "text")
    found = written(whole.repartition(tasks, "task").sortWithinPartitions("task").mapInArrow(tidy(_verify(words, threshold, tolerance)), "cls long, links long, root long"))

    reclaim(docs.sparkSession)
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("cls").alias("u"), F.col("root").alias("v")))
    per_class = classes.select("s1", "s2", "cls", "copies").join(links, "cls", "left").join(groups.withColumnRenamed("node", "cls"), "cls", "left")
    per_class = per_class.select(F.col("s1").alias("_1"), F.col("s2").alias("_2"), F.coalesce("component", "cls").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), (F.col("copies") - 1).alias("n_copies"))
    same = (signed["s1"] == per_class["_1"]) & (signed["s2"] == per_class["_2"]) & (signed["n"] > 0) & signed["doc_id"].isNotNull()
    none = F.lit(0).cast("long")
    return signed.join(per_class, same, "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", none).alias("n_links"), F.coalesce("n_copies", none).alias("n_copies"), F.col("n").cast("long").alias("n_shingles"))
