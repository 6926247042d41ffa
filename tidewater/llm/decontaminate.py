"""Benchmark decontamination with an FM-index per shard of the training documents.

Each task takes shards of its documents' words, keeps the runs that could hold
a benchmark window at all (runs of words that the benchmark has, as long as its
shortest window), and indexes them.  All windows are then searched backwards at
once, their occurrences located by sampled suffix positions, and the words they
cover merged into removal spans.  Nothing is shuffled.

The benchmark goes to all tasks in blocks of a checked size; a larger benchmark
means more passes, not larger tasks.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased.
Null and empty texts have no words and no hits; an item without words has no
window.  An item without an id still removes words but isn't named.  Repeated
rows are handled one by one.  Other columns come back unchanged, unless they
bear the name of a new one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import written
from .fmindex import FMIndex
from .tables import unused
from .textbuf import LOWER, WORD_BYTE, chunk_word_hashes, flat, gathered, tidy

NEW = ("n_words", "hit_words", "items", "spans")


class Phrases:
    """Distinct windows of the benchmark's items as rows of word numbers from 1 on, and the items of each."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        buf, offs = flat(pa.array([t or "" for _, t in items], pa.large_string()))
        _, _, rows, hashes = chunk_word_hashes(LOWER[buf], offs, WORD_BYTE)
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes) + 1
        found: dict[tuple[int, ...], set[str]] = {}
        bounds = np.searchsorted(rows, np.arange(len(items) + 1))
        for (name, _), lo, hi in zip(items, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = numbers[lo:hi].tolist()
            for at in range(max(1, len(own) - window + 1) if own else 0):
                found.setdefault(tuple(own[at : at + window]), set()).update([name] if name is not None else [])
        self.lengths = np.array([len(w) for w in found], np.int64)
        self.rows = np.zeros((len(found), window), np.int64)
        for i, w in enumerate(found):
            self.rows[i, : len(w)] = w
        self.items = [sorted(x) for x in found.values()]

    def search(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word starts, ends and rows; whether each word is hit; the row and the window of each occurrence."""
        starts, ends, rows, hashes = chunk_word_hashes(LOWER[buf], offs, WORD_BYTE)
        none = np.zeros(0, np.int64)
        hit = np.zeros(len(starts), bool)
        if not len(self.lengths) or not len(starts):
            return starts, ends, rows, hit, none, none
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        number = np.where(self.vocabulary[at] == hashes, at + 1, 0)
        known = np.flatnonzero(number)
        if not len(known):
            return starts, ends, rows, hit, none, none
        head = np.flatnonzero(np.r_[True, (known[1:] != known[:-1] + 1) | (rows[known[1:]] != rows[known[:-1]])])
        size = np.diff(np.r_[head, len(known)])
        long_enough = size >= self.lengths.min()
        head, size = head[long_enough], size[long_enough]
        total = int((size + 1).sum())
        text, word = np.zeros(total, np.int64), np.full(total, -1, np.int64)
        run = np.repeat(np.arange(len(size)), size)
        step = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
        place = np.repeat(np.cumsum(size + 1) - size - 1, size) + step
        source = known[head[run] + step]
        text[place], word[place] = number[source], source
        index = FMIndex(text, len(self.vocabulary) + 1)
        lo, hi = index.search(self.rows, self.lengths)
        which = np.repeat(np.arange(len(lo)), np.maximum(hi - lo, 0))
        row = np.arange(len(which)) - np.repeat(np.cumsum(np.maximum(hi - lo, 0)) - np.maximum(hi - lo, 0), np.maximum(hi - lo, 0)) + lo[which]
        first = word[index.locate(row)]
        steps = np.zeros(len(starts) + 1, np.int64)
        np.add.at(steps, first, 1)
        np.add.at(steps, first + self.lengths[which], -1)
        return starts, ends, rows, np.cumsum(steps[:-1]) > 0, rows[first], which


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), values)


def _search(phrases, text_at: int, shard: int, hits_at: int | None = None):
    """The block's columns and the new ones; with ``hits_at``, the place of hit_words and items of an earlier pass, which are taken up and left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Phrases = phrases.value
        for block in gathered(batches, "text", shard):
            n = block.num_rows
            buf, offs = flat(block.column(text_at))
            starts, ends, rows, hit, doc, which = own.search(buf, offs)
            words = np.bincount(rows, minlength=n)
            base = np.searchsorted(rows, np.arange(n))
            items: dict[int, set[str]] = {}
            for d, w in np.unique(np.stack([doc, which]), axis=1).T.tolist():
                items.setdefault(d, set()).update(own.items[w])
            kept = list(range(block.num_columns))
            if hits_at is not None:
                kept = kept[:hits_at] + kept[hits_at + 2 :]
                before = block.column(hits_at)
                hit[np.repeat(base, np.diff(before.offsets.to_numpy())) + before.flatten().to_numpy()] = True
                for d, names in enumerate(block.column(hits_at + 1).to_pylist()):
                    if names:
                        items.setdefault(d, set()).update(names)
            at = np.flatnonzero(hit)
            names = [sorted(items.get(i, ())) for i in range(n)]
            # runs of words that are hit, as bytes from the start of the first to the end of the last
            head = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (rows[at[1:]] != rows[at[:-1]])]) if len(at) else at
            tail = np.r_[head[1:], len(at)] - 1 if len(at) else at
            of = rows[at[head]]
            spans = pa.StructArray.from_arrays([pa.array(starts[at[head]] - offs[of]), pa.array(ends[at[tail]] - offs[of])], names=["start", "end"])
            yield pa.RecordBatch.from_arrays(
                [*[block.column(i) for i in kept], pa.array(words.astype(np.int64)), _lists(np.bincount(rows[at], minlength=n), pa.array((at - base[rows[at]]).astype(np.int64))), pa.array(names, pa.list_(pa.string())), _lists(np.bincount(of, minlength=n), spans)],
                names=[*[block.schema.names[i] for i in kept], *NEW],
            )

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_bytes: int = 16 << 20, block_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_words, hit_words (array of word numbers from 0), items (array of item ids as strings, sorted) and spans (array of start and end bytes of maximal runs of hit words).

    A document word is hit if it is inside any occurrence of a window:
    ``window`` consecutive words of an item of ``benchmark`` (item_id, text), or
    the whole of a shorter item.  Words are equal if their 64-bit hashes are.  Of
    columns that are called like a new one only the new one is left.  A benchmark
    of more than ``block_bytes`` is searched for in several passes over the
    documents, with the same result.
    """
    spark = docs.sparkSession
    docs = docs.select(*[c for c in docs.columns if c not in NEW])
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / block_bytes))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    new = "n_words long, hit_words array<long>, items array<string>, spans array<struct<start: long, end: long>>"
    hits = unused(docs.columns, "hits")
    names = unused([*docs.columns, hits], "names")
    out, text_at = None, docs.columns.index("text")
    for k in range(parts):
        own = bench if parts == 1 else bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        phrases = spark.sparkContext.broadcast(Phrases([(r[0], r[1]) for r in own.toLocalIterator()], window))
        if out is None:
            out = docs.mapInArrow(tidy(_search(phrases, text_at, shard_bytes)), f"{kinds}, {new}")
        else:
            before = written(out).select(*docs.columns, F.col("hit_words").alias(hits), F.col("items").alias(names))
            out = before.mapInArrow(tidy(_search(phrases, text_at, shard_bytes, len(docs.columns))), f"{kinds}, {new}")
    return out


def _without(text_at: int, spans_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in gathered(batches, "text", 4 << 20):
            texts = block.column(text_at).to_pylist()
            for i, spans in enumerate(block.column(spans_at).to_pylist()):
                if spans:
                    raw, kept, at = texts[i].encode(), [], 0
                    for s in sorted((x["start"], x["end"]) for x in spans):
                        kept.append(raw[at : max(at, s[0])])
                        at = max(at, s[1])
                    texts[i] = (b"".join(kept) + raw[at:]).decode()
            columns = list(block.columns)
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(columns) if i != spans_at], names=[x for i, x in enumerate(block.schema.names) if i != spans_at])

    return run


def remove_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``spans`` (as above) taken out of ``text``, and without that column; spans begin and end with words, so no character is cut."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "spans")
    return docs.mapInArrow(tidy(_without(docs.columns.index("text"), docs.columns.index("spans"))), kinds)
