"""An n-gram language model by deleted interpolation, and the log-probability of every text under it.

The model mixes maximum-likelihood estimates of all orders and a uniform one.
The mixture depends on how often the context was seen in training (a bucket for
each power of two).  Its weights are learned by expectation-maximisation on
held-out counts: each training token in turn is held out, that is, its own
occurrence is deleted from all counts before they are used to predict it.

Counts are of the whole training part of the corpus and grow with it, so no task
holds them all.  Texts are tokenised once, into blocks: rows that hold many
documents' tokens as numbers of the block's sorted vocabulary.  For each order a
block sends its distinct n-grams (hashes, sorted, as differences), with its own
training counts, to the parts of the key space; a part adds up all blocks'
counts and answers each block.  A frequent n-gram thus costs one entry a block,
and a part is one range of keys of about ``part_keys`` entries, whatever the
corpus.  Answers meet their block in one join; then every token's counts are at
hand.  The weights are learned from a histogram of quantised estimates, each
bucket's in a task of its own; what the driver gets is the weights and totals.

A block sends a message to each part, so the number of messages is that of the
blocks times that of the parts, and both grow with the corpus: see the README.

Words and n-grams are told apart by 64-bit hashes.

Tokens are runs of other than white space, A-Z lower-cased, and one end token
for each text.  Null and empty texts are one end token.  Repeated rows are
scored and counted one by one.  Without training texts every token has the
uniform probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import discard, reclaim, written
from .suffix import _whole_groups
from .textbuf import BASE, LOWER, NOT_SPACE, U64, chunk_word_hashes, flat, gathered, mix64, tidy

#: Hashes of the end token and of the place before the first token; no word's bytes hash to them but by chance.
END, START = U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB)
#: Steps of the quantised estimates to a factor of two, for learning weights.
STEPS = 4
#: Parts, and blocks, are dealt to this many tasks at most.
MOST_TASKS = 50_000
#: Rounds of expectation-maximisation.
ROUNDS = 60
#: The quantised estimate 0; no estimate of a corpus is as small as 2**(NEVER / STEPS).
NEVER = -(1 << 9)


def _pack(x: np.ndarray) -> bytes:
    """Compressed numbers, their bytes place by place: the high ones are mostly zero."""
    x = np.ascontiguousarray(x)
    places = x.view(np.uint8).reshape(-1, x.itemsize).T if x.itemsize > 1 else x
    return zstandard.compress(np.ascontiguousarray(places).tobytes(), 1)


def _unpack(b: bytes, kind) -> np.ndarray:
    places = np.frombuffer(zstandard.decompress(b), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(places.reshape(size, -1).T).view(kind).ravel() if size > 1 else places


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences of the fewest whole bytes that hold them all, compressed byte place by byte place."""
    if not len(keys):
        return b""
    gaps = np.r_[U64(0), keys[1:] - keys[:-1]]
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    places = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + int(keys[0]).to_bytes(8, "little") + _pack(places)


def unpack_sorted(b: bytes) -> np.ndarray:
    if not b:
        return np.zeros(0, np.uint64)
    raw = _unpack(b[9:], np.uint8).reshape(b[0], -1).T
    gaps = np.zeros((len(raw), 8), np.uint8)
    gaps[:, : b[0]] = raw
    return np.cumsum(gaps.view("<u8").ravel()) + U64(int.from_bytes(b[1:9], "little"))


BLOCKS = "block long, docs array<struct<doc_id: {}, held: boolean, tokens: int>>, vocabulary binary, tokens binary, n long, words long"


def _tokenise(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, block in enumerate(gathered(batches, "text", most)):
            rows = block.num_rows
            buf, offs = flat(block.column(1))
            _, _, row, h = chunk_word_hashes(LOWER[buf], offs, NOT_SPACE)
            count = np.bincount(row, minlength=rows) + 1
            ends = np.cumsum(count) - 1
            all_tokens = np.empty(int(count.sum()), np.uint64)
            is_word = np.ones(len(all_tokens), bool)
            is_word[ends] = False
            all_tokens[is_word], all_tokens[ends] = h, END
            vocabulary, numbers = np.unique(all_tokens, return_inverse=True)
            docs = pa.StructArray.from_arrays([block.column(0), block.column(2), pa.array(count.astype(np.int32))], names=["doc_id", "held", "tokens"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + k]), pa.ListArray.from_arrays(pa.array([0, rows], pa.int32()), docs), pa.array([pack_sorted(vocabulary)], pa.binary()), pa.array([_pack(numbers.astype(np.int32))], pa.binary()), pa.array([len(numbers)]), pa.array([len(vocabulary)])],
                names=["block", "docs", "vocabulary", "tokens", "n", "words"],
            )

    return run


class Block:
    """One block's tokens, with the n-grams of each order."""

    def __init__(self, docs: pa.Array, vocabulary: bytes, tokens: bytes):
        self.docs = docs
        self.hashes = unpack_sorted(vocabulary)
        self.tokens = _unpack(tokens, np.int32)
        self.count = docs.field(2).to_numpy()
        self.first = np.cumsum(self.count) - self.count
        self.held = docs.field(1).to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(len(self.count)), self.count)
        self.place = np.arange(len(self.tokens)) - self.first[self.row]
        self.train = ~self.held[self.row]

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct n-gram hashes, the number of each token's own (that ends there; -1 where the text has too few before), and training counts."""
        h = self.hashes[self.tokens]
        ok = self.place >= order - 2  # one place before the first token counts as a token
        key = h
        for back in range(1, order):
            before = np.roll(h, back)
            before[self.place < back] = START
            key = mix64(key * U64(BASE) + before + U64(back))
        distinct, number = np.unique(key[ok], return_inverse=True)
        out = np.full(len(key), -1, np.int64)
        out[ok] = number
        return distinct, out, np.bincount(number[self.train[ok]], minlength=len(distinct))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Block]]:
    """Blocks of batches with block, docs, vocabulary, tokens first."""
    for b in batches:
        for i in range(b.num_rows):
            docs = b.column(1).slice(i, 1).flatten()
            yield b, i, Block(docs, b.column(2)[i].as_py(), b.column(3)[i].as_py())


def _part_edges(parts: int) -> np.ndarray:
    """First key of each part; ranges of the key space."""
    return np.array([(k << 64) // parts for k in range(parts)], np.uint64)


def _ask(order: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _part_edges(parts)
        for b, i, block in _blocks(batches):
            keys, _, counts = block.grams(order)
            at = np.r_[np.searchsorted(keys, edges), len(keys)]
            which = [k for k in range(parts) if at[k] < at[k + 1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(which, pa.int32()),
                    pa.array([b.column(0)[i].as_py()] * len(which), pa.int64()),
                    pa.array([pack_sorted(keys[at[k] : at[k + 1]]) for k in which], pa.binary()),
                    pa.array([_pack(counts[at[k] : at[k + 1]].astype(np.uint32)) for k in which], pa.binary()),
                ],
                names=["part", "block", "keys", "counts"],
            )

    return run


ANSWERS = "part int, block long, counts binary, total long, distinct long"


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _whole_groups(batches, 0, 1):
        part = table.column(0).to_numpy()
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = table.slice(lo, hi - lo)
            keys = [unpack_sorted(x) for x in own.column(2).to_pylist()]
            size = np.cumsum([0, *map(len, keys)])
            counts = np.concatenate([_unpack(x, np.uint32) for x in own.column(3).to_pylist()]).astype(np.float64)
            distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(number, counts, len(distinct)).astype(np.int64)
            of_each = total[number]
            told = [_pack(of_each[a:b].astype(np.uint64 if total.max() >= 1 << 32 else np.uint32)) + bytes([8 if total.max() >= 1 << 32 else 4]) for a, b in zip(size[:-1], size[1:], strict=True)]
            n = len(told)
            once = np.zeros(n, np.int64)
            whole, kinds = once.copy(), once.copy()
            whole[0], kinds[0] = total.sum(), np.count_nonzero(total)
            yield pa.RecordBatch.from_arrays([own.column(0).combine_chunks(), own.column(1).combine_chunks(), pa.array(told, pa.binary()), pa.array(whole), pa.array(kinds)], names=["part", "block", "counts", "total", "distinct"])


def _look_up(orders: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, i, block in _blocks(batches):
            answers: dict[int, list[tuple[int, bytes]]] = {}
            for x in b.column(4)[i].as_py():
                answers.setdefault(x["order"], []).append((x["part"], x["counts"]))
            columns = []
            for order in range(1, orders + 1):
                _, number, _ = block.grams(order)
                got = [_unpack(x[:-1], np.uint64 if x[-1] == 8 else np.uint32).astype(np.int64) for _, x in sorted(answers.get(order, []))]
                told = np.concatenate([*got, np.zeros(1, np.int64)])  # the last is for n-grams that reach back too far
                columns.append(pa.array([_pack(told[number].astype(np.uint32 if told.max() < 1 << 32 else np.uint64)) + bytes([4 if told.max() < 1 << 32 else 8])], pa.binary()))
            yield pa.RecordBatch.from_arrays([b.column(1).slice(i, 1), *columns], names=["docs", *[f"c{k}" for k in range(1, orders + 1)]])

    return run


class Counts:
    """Each token's counts of all orders, of its contexts, and its row."""

    def __init__(self, b: pa.RecordBatch, i: int, orders: int, texts: int):
        self.docs = b.column(0).slice(i, 1).flatten()
        size = self.docs.field(2).to_numpy()
        self.size, self.held = size, self.docs.field(1).to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(len(size)), size)
        self.first = np.cumsum(size) - size
        place = np.arange(len(self.row)) - self.first[self.row]
        self.own = []
        for k in range(1, orders + 1):
            raw = b.column(k)[i].as_py()
            self.own.append(_unpack(raw[:-1], np.uint32 if raw[-1] == 4 else np.uint64).astype(np.int64))
        self.context = [None]
        for k in range(2, orders + 1):
            c = np.roll(self.own[k - 2], 1)
            c[place == 0] = texts if k == 2 else 0
            self.context.append(c)

    def estimates(self, less: np.ndarray, total: int, kinds: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Bucket of each token's context, and estimates of order 0, 1, ..., with ``less`` taken from every count."""
        out = [np.full(len(self.row), 1 / (kinds + 1)), (self.own[0] - less) / np.maximum(total - less, 1)]
        bucket = np.zeros(len(self.row), np.int64)
        for k in range(1, len(self.own)):
            c = self.context[k] - less
            seen = c > 0
            out.append(np.where(seen, (self.own[k] - less) / np.maximum(c, 1), 0.0))
            bucket = np.where(seen, 64 * k + np.frexp(np.maximum(c, 1).astype(np.float64))[1], bucket)
        return bucket, [np.maximum(x, 0) for x in out]


def _histogram(orders: int, texts: int, total: int, kinds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = Counts(b, i, orders, texts)
                train = ~x.held[x.row]
                bucket, f = x.estimates(train.astype(np.int64), total, kinds)
                q = [np.where(y > 0, np.rint(STEPS * np.log2(np.maximum(y, 1e-300))), NEVER).astype(np.int64)[train] for y in f[1:]]
                # one number for each cell: the bucket, then the estimates, each from NEVER to 0
                key = bucket[train]
                for y in q:
                    key = key * (1 - NEVER) + (y - NEVER)
                cell, n = np.unique(key, return_counts=True)
                cells = []
                for _ in q:
                    cells.append(cell % (1 - NEVER) + NEVER)
                    cell = cell // (1 - NEVER)
                cells = [cell, *reversed(cells)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cells), pa.array(n)], names=["bucket", *[f"q{k}" for k in range(1, orders + 1)], "n"])

    return run


def learn_weights(cells: np.ndarray, n: np.ndarray, orders: int, kinds: int, rounds: int = ROUNDS) -> dict[int, np.ndarray]:
    """Expectation-maximisation of the mixture in each bucket; ``cells`` holds bucket and quantised estimates of order 1, 2, ..."""
    out = {}
    for bucket in np.unique(cells[:, 0]).tolist():
        own = cells[:, 0] == bucket
        f = np.c_[np.full(int(own.sum()), 1 / (kinds + 1)), np.where(cells[own, 1:] > NEVER, 2.0 ** (cells[own, 1:] / STEPS), 0)]
        w = np.full(orders + 1, 1 / (orders + 1))
        for _ in range(rounds):
            part = f * w
            part /= part.sum(axis=1, keepdims=True)
            w = (part * n[own, None]).sum(axis=0) / n[own].sum()
            w = np.maximum(w, 1e-9)
            w /= w.sum()
        out[bucket] = w
    return out


def _learn(orders: int, kinds: int):
    def run(own: pa.Table) -> pa.Table:
        table = np.stack([c.to_numpy() for c in own.columns], axis=1)
        weights = learn_weights(table[:, :-1], table[:, -1], orders, kinds)
        return pa.table({"bucket": pa.array(list(weights), pa.int64()), "weights": pa.array([w.tolist() for w in weights.values()], pa.list_(pa.float64()))})

    return run


def weight_table(weights: dict[int, np.ndarray], orders: int) -> np.ndarray:
    """Weights by bucket number; a bucket that training never saw takes those of the nearest below it with the same or a shorter context."""
    table = np.zeros((64 * (orders + 1), orders + 1))
    last = np.r_[0.5, 0.5, np.zeros(orders - 1)]
    for k in range(len(table)):
        last = weights.get(k, last)
        table[k] = last
    return table


def _score(orders: int, texts: int, total: int, kinds: int, table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = Counts(b, i, orders, texts)
                bucket, f = x.estimates(np.zeros(len(x.row), np.int64), total, kinds)
                p = sum(w * y for w, y in zip(table[bucket].T, f, strict=True))
                score = np.add.reduceat(np.log10(p), x.first)
                base = np.add.reduceat(np.log10((x.own[0] + 0.1) / (total + 0.1 * (kinds + 1))), x.first)
                known = np.add.reduceat((x.own[0] > 0).astype(np.int64), x.first)
                yield pa.RecordBatch.from_arrays([x.docs.field(0), x.docs.field(1), pa.array(x.size.astype(np.int64)), pa.array(known), pa.array(np.full(len(known), total)), pa.array(base), pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score(docs: DataFrame, held_out: Column, order: int = 3, block_bytes: int = 6 << 20, part_keys: int = 1_000_000) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text).

    Rows where ``held_out`` is true don't train the model.  ``score`` is the
    model's log10 probability of the text, ``base_score`` that of add-0.1
    smoothed unigrams.  ``order`` is the length of the longest n-grams.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(held_out, F.lit(False)).alias("held")
    blocks = written(docs.select("doc_id", "text", held).mapInArrow(tidy(_tokenise(block_bytes)), BLOCKS.format(kind)))
    sizes = blocks.agg(F.sum("n").alias("n"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("blocks")).first()
    if not sizes["n"]:
        return spark.createDataFrame([], f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    texts = blocks.select(F.size(F.filter("docs", lambda d: ~d["held"])).alias("n")).agg(F.sum("n")).first()[0]
    answers, total, kinds, steps = None, 0, 0, [blocks]
    for k in range(1, order + 1):
        keys = sizes["words"] if k == 1 else sizes["n"]
        parts = max(-(-keys // part_keys), spark.sparkContext.defaultParallelism)
        asked = blocks.select("block", "docs", "vocabulary", "tokens").mapInArrow(tidy(_ask(k, parts)), "part int, block long, keys binary, counts binary")
        # a task gets a part or two, however many there are
        told = written(asked.repartition(min(parts, MOST_TASKS), "part").sortWithinPartitions("part").mapInArrow(tidy(_answer), ANSWERS))
        steps.append(told)
        reclaim(spark)
        if k == 1:
            total, kinds = told.agg(F.sum("total"), F.sum("distinct")).first()
        told = told.select("block", F.struct(F.lit(k).alias("order"), "part", "counts").alias("answer"))
        answers = told if answers is None else answers.unionByName(told)
    tasks = min(sizes["blocks"], MOST_TASKS)  # a block or two each, as their number grows with the corpus
    per_block = answers.repartition(tasks, "block").groupBy("block").agg(F.collect_list("answer").alias("answers"))
    met = blocks.select("block", "docs", "vocabulary", "tokens").repartition(tasks, "block").join(per_block, "block")
    counted = ", ".join(f"c{k} binary" for k in range(1, order + 1))
    counts = written(met.mapInArrow(tidy(_look_up(order)), f"{BLOCKS.format(kind).split('vocabulary')[0].split('block long, ')[1]}{counted}"))

    discard(*steps)
    reclaim(spark)
    quantised = ", ".join(f"q{k} long" for k in range(1, order + 1))
    cells = counts.mapInArrow(tidy(_histogram(order, texts, total, kinds)), f"bucket long, {quantised}, n long")
    cells = cells.groupBy(*cells.columns[:-1]).agg(F.sum("n").alias("n"))  # bounded by the steps of each estimate
    learned = cells.groupBy("bucket").applyInArrow(_learn(order, kinds), "bucket long, weights array<double>").collect()  # 64 buckets an order at most
    weights = {r["bucket"]: np.array(r["weights"]) for r in sorted(learned)}
    return counts.mapInArrow(tidy(_score(order, texts, total, kinds, weight_table(weights, order))), "doc_id " + kind + ", held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
