"""Best-fit decreasing packing of documents into sequences of a fixed number of tokens.

Tokenising is a map over the documents.  Packing needs the lengths only: with at
most ``capacity`` distinct lengths, their histogram is all that the driver gets,
whatever the number of documents.  Best-fit decreasing runs on that histogram,
moving all pieces of one length that go to equally full bins at once; a segment
tree over remaining capacities gives the tightest open bins.  The resulting plan
(ranges of ranks within a length -> ranges of bins) is joined back to the
pieces, which are ranked within their length by salted groups.

Null and empty texts are one piece holding just the end token.  Repeated rows
are packed one by one; which of equal rows gets which place is nowhere to be seen.
An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import written
from .tables import unused
from .textbuf import blocks, tidy

_encoders: dict[tuple[str, str], object] = {}


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 as it is, the other bytes in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Byte strings with their ids, which are their merging ranks too, and special strings with theirs, of a byte-level BPE file: JSON of ``tokenizers``, or ranks of ``tiktoken`` (no special strings)."""
    if not path.endswith(".json"):
        with open(path, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, {}
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, added = spec["model"], spec["added_tokens"]
    if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError("not a plain byte-level BPE vocabulary")
    byte = _byte_letters()
    special = {t["content"]: t["id"] for t in added}
    table = {bytes(byte[x] for x in word): n for word, n in model["vocab"].items() if word not in special}
    made = [model["vocab"]["".join(pair)] for pair in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
    if any(x >= y for x, y in zip(made, made[1:], strict=False)):
        raise ValueError("ids aren't in the order of the merges")
    return table, special


def encoder(path: str, pattern: str):
    """The tokenizer of a vocabulary file, kept per process; special strings in a text get their own ids."""
    import tiktoken

    if (path, pattern) not in _encoders:
        table, special = vocabulary(path)
        _encoders[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens=special)
    return _encoders[path, pattern]


def _tokenise(path: str, pattern: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for block in blocks(batches, "text", 2 << 20):
            out: list[tuple] = []
            for doc, text in zip(block.column(0).to_pylist(), block.column(1).to_pylist(), strict=True):
                ids = np.array([*own.encode(text or "", allowed_special="all"), end], "<u4")
                first = (len(ids) - 1) % capacity + 1
                edges = [0, *range(first, len(ids) + 1, capacity)]
                out += [(doc, k, a, b - a, ids[a:b].tobytes()) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (block.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "piece", "start", "length", "ids"])

    return run


def tokenise(docs: DataFrame, path: str, pattern: str, capacity: int = 1024, end: int = 2) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids: little-endian unsigned 32-bit) of all documents, each with ``end`` after its last id; texts over ``capacity`` are cut into full pieces behind a first one that may be shorter."""
    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(tidy(_tokenise(path, pattern, capacity, end)), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids binary")


class Tightest:
    """Segment tree over remaining capacities 0..capacity: the least one, from a given one on, that has open bins."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, at: int, has: bool) -> None:
        at += self.leaves
        self.any[at] = has
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def at_least(self, least: int) -> int | None:
        at = least + self.leaves
        while not self.any[at]:
            while at & 1:  # a right child: go up until there is a right neighbour
                at //= 2
                if at <= 1:
                    return None
            at += 1
        while at < self.leaves:
            at = 2 * at + (not self.any[2 * at])
        return at - self.leaves


def best_fit(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over ``length -> count``: rows (length, first rank, one past the last, first bin, offset) and the number of bins.

    Rank r of such a row lies in bin ``first bin + r - first rank``.  Placing one
    piece makes its bin the tightest one that may still fit the next of the same
    length, so a bin takes ``remaining // length`` of them before the next bin.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    open_bins: dict[int, list[tuple[int, int]]] = {}  # remaining -> ranges of bins
    tree, bins = Tightest(capacity), 0

    def keep(left: int, first: int, count: int) -> None:
        if left and count:
            open_bins.setdefault(left, []).append((first, count))
            tree.set(left, True)

    for length in sorted(histogram, reverse=True):
        rank, todo = 0, histogram[length]
        while todo:
            left = tree.at_least(length)
            if left is None:
                left, each = capacity, capacity // length
                first, have = bins, -(-todo // each)
                bins += have
            else:
                each = left // length
                first, have = open_bins[left].pop()
                if not open_bins[left]:
                    tree.set(left, False)
            full = min(have, todo // each)
            for k in range(each if full else 0):
                plan.append((length, rank, rank + full, first, capacity - left + k * length))
                rank += full
            todo -= full * each
            keep(left - each * length, first, full)
            rest = 0
            if todo and full < have:  # fewer than a bin takes
                rest = todo
                for k in range(rest):
                    plan.append((length, rank, rank + 1, first + full, capacity - left + k * length))
                    rank += 1
                todo = 0
                keep(left - rest * length, first + full, 1)
            untouched = have - full - (rest > 0)
            keep(left, first + full + (rest > 0), untouched)
    return plan, bins


def pack(pieces: DataFrame, capacity: int = 1024, group: int = 100_000, most_groups: int = 1 << 18) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with ``sequence_id`` and ``offset``.

    Every piece has from 1 to ``capacity`` tokens.  The pieces of one length are
    ranked in as many salted groups as keep each at about ``group`` rows
    (``most_groups`` in all, beyond which groups grow).  The driver gets one row
    for each length and for each group; they and the plan, a few rows for each
    length, are broadcast.  Rows are ordered by all their columns, so a task that is
    run again ranks them alike.
    """
    spark = pieces.sparkSession
    pieces = pieces.select(*[c for c in pieces.columns if c not in ("sequence_id", "offset")])
    salts_, salt_, nth_, before_, rank_, from_, to_, bin_, size_ = (unused(pieces.columns, c) for c in ("_salts", "_salt", "_nth", "_before", "_rank", "_from", "_to", "_bin", "_size"))
    sizes = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    each = max(group, -(-sum(sizes.values()) // most_groups))
    dealt = F.broadcast(spark.createDataFrame([(n, -(-k // each)) for n, k in sizes.items()], f"{size_} long, {salts_} int"))
    own = F.pmod(F.xxhash64("doc_id", "piece"), F.col(salts_)).cast("int")
    salted = pieces.join(dealt, pieces["length"] == dealt[size_]).withColumn(salt_, own).drop(size_, salts_)
    counts = salted.groupBy("length", salt_).agg(F.count(F.lit(1)).alias("n"))
    seen: dict[int, int] = {}
    before = []
    for r in sorted(counts.collect()):
        before.append((r["length"], r[salt_], seen.get(r["length"], 0)))
        seen[r["length"]] = seen.get(r["length"], 0) + r["n"]
    plan, _ = best_fit(seen, capacity)
    ranks = F.broadcast(spark.createDataFrame(before, f"length long, {salt_} int, {before_} long"))
    moves = F.broadcast(spark.createDataFrame(plan, f"{size_} long, {from_} long, {to_} long, {bin_} long, offset long"))
    others = [f.name for f in pieces.schema.fields if f.name not in ("doc_id", "piece", "length") and f.dataType.typeName() not in ("map", "variant")]
    nth = F.row_number().over(Window.partitionBy("length", salt_).orderBy("doc_id", "piece", *[F.col(f"`{c}`") for c in others])) - 1
    ranked = salted.withColumn(nth_, nth).join(ranks, ["length", salt_]).withColumn(rank_, F.col(nth_) + F.col(before_))
    placed = ranked.join(moves, (ranked["length"] == moves[size_]) & (ranked[rank_] >= moves[from_]) & (ranked[rank_] < moves[to_]))
    return placed.select(*[ranked[f"`{c}`"] for c in pieces.columns], (F.col(bin_) + F.col(rank_) - F.col(from_)).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str, pattern: str, capacity: int = 1024, end: int = 2, digest=None) -> DataFrame:
    """tokenise() and pack(); ``digest`` maps the tokenised pieces to the columns that are kept, by default all of them, ids too."""
    pieces = tokenise(docs, path, pattern, capacity, end)
    return pack(written(digest(pieces) if digest else pieces), capacity)
