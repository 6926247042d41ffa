"""Toxicity by a bidirectional gated recurrent network over character and word inputs.

A word's inputs are what training documents tell about it (the log-odds of the
word itself) and about its characters (those of its character n-grams, with the
word's borders).  Windows of ``WINDOW`` words, each overlapping the next by half,
cover the whole text; the network gives each a logit by attention pooling, and a
logistic regression turns the highest and the mean logits of a document's windows
into its score.

The network is trained on windows of a bounded sample of labelled documents
(PER_CLASS rows of each class).  The log-odds that a training document
sees come from the other training documents (four parts in turn), so that the
network learns how far to trust them on new texts.  Which windows of a toxic
document are toxic isn't known: the highest are taken, first by their words, then
by the network.

Null and empty texts, and texts without words, have no window and get the score
of a document whose windows are all at the lowest logit.  Without labels of both
classes every score is the share of label 1 (0 if there are none).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import recurrent
from .labelled import Sample, sample
from .textbuf import BASE, BYTE_VALUE, LOWER, U64, WORD_BYTE, Prefix, blocks, chunk_word_hashes, flat, mix64, release, tidy

WINDOW, STRIDE = 32, 16
BITS = 18
GRAMS = (3, 4, 5, 6)
PARTS = 4
#: At most so many labelled documents of each class train the network.
PER_CLASS = 600
F32 = np.float32


@dataclass
class Words:
    """The distinct words of some texts and where they stand."""

    number: np.ndarray  # of each word in the texts
    row: np.ndarray
    hashes: np.ndarray  # of each distinct word
    length: np.ndarray
    gram: np.ndarray  # hashed character n-grams of the distinct words, word by word
    gram_at: np.ndarray  # where each word's begin, and the end


def read_words(column: pa.Array) -> Words:
    buf, offs = flat(column)
    low = LOWER[buf]
    starts, ends, rows, hashes = chunk_word_hashes(low, offs, WORD_BYTE)
    distinct, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    s, length = starts[first], ends[first] - starts[first]
    # the distinct words, each between two border bytes, in a buffer of their own
    at = np.cumsum(length + 2) - length - 2
    text = np.full(int((length + 2).sum()), 1, np.uint8)
    within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    text[np.repeat(at + 1, length) + within] = low[np.repeat(s, length) + within]
    del within
    value = BYTE_VALUE[text]
    word_of = np.repeat(np.arange(len(distinct), dtype=np.int32), length + 2)
    left = (np.repeat(at + length + 2, length + 2) - np.arange(len(text))).astype(np.int32)  # bytes to the word's end
    each = [np.maximum(length + 2 - n + 1, 0) for n in GRAMS]
    gram_at = np.r_[0, np.cumsum(np.sum(each, axis=0))] if len(distinct) else np.zeros(1, np.int64)
    gram = np.empty(int(gram_at[-1]), np.int32)
    base = gram_at[:-1].copy()
    for n, count in zip(GRAMS, each, strict=True):
        if len(text) < n:
            continue
        h = np.zeros(len(text) - n + 1, np.uint64)
        for i in range(n):
            h = h * U64(BASE) + value[i : len(text) - n + 1 + i]
        ok = left[: len(h)] >= n
        owner = word_of[: len(h)][ok]
        gram[base[owner] + np.arange(len(owner)) - (np.cumsum(count) - count)[owner]] = mix64(h[ok] + U64(n)) >> U64(64 - BITS)
        base += count
    return Words(number.astype(np.int32), rows.astype(np.int32), distinct, length, gram, gram_at)


class Odds:
    """Weights of the documents with each hashed feature, by part and class."""

    def __init__(self, part: np.ndarray, y: np.ndarray, weight: np.ndarray):
        mean = [weight[y == k].mean() for k in (0, 1)]
        self.cell, self.weight = part * 2 + y, weight / np.where(y == 1, mean[1], mean[0])
        self.docs = np.bincount(self.cell, self.weight, 2 * PARTS).reshape(PARTS, 2)
        self.count = np.zeros((2 * PARTS, 1 << BITS), F32)

    def add(self, rows: np.ndarray, bucket: np.ndarray) -> None:
        """Features of some documents; no document is in two calls."""
        pair = np.unique(rows.astype(np.int64) << BITS | bucket)
        np.add.at(self.count, (self.cell[pair >> BITS], pair & ((1 << BITS) - 1)), self.weight[pair >> BITS].astype(F32))

    def table(self, without: int | None, strength: float) -> np.ndarray:
        """Smoothed log-odds of each feature, from all parts but one."""
        use = [k for k in range(PARTS) if k != without]
        count = self.count.reshape(PARTS, 2, -1)[use].sum(axis=0)
        docs = np.maximum(self.docs[use].sum(axis=0), 1e-9)
        share = docs / docs.sum()
        return (np.log((count[1] + strength * share[1]) / docs[1]) - np.log((count[0] + strength * share[0]) / docs[0])).astype(F32)


def _features(words: Words, word_odds: np.ndarray, gram_odds: np.ndarray) -> np.ndarray:
    """Inputs of each distinct word; a row for filling follows."""
    n = len(words.hashes)
    out = np.zeros((n + 1, 7), F32)
    out[:n, 0] = word_odds[(words.hashes >> U64(64 - BITS)).astype(np.int64)]
    if n:  # every word has one n-gram at least, with its borders
        o = gram_odds[words.gram]
        at = words.gram_at[:-1]
        out[:n, 1] = np.maximum.reduceat(o, at)
        out[:n, 2] = np.add.reduceat(o, at) / np.diff(words.gram_at)
        out[:n, 3] = np.minimum.reduceat(o, at)
    out[:n, 4] = np.minimum(words.length, 30) / F32(10)
    out[:n, 5] = 1
    out[n, 6] = 1
    return out


def windows(words: Words, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of each window (filled up with the number after the last), which are real, and the row of each window."""
    count = np.bincount(words.row, minlength=rows)
    each = np.where(count > 0, np.maximum(-(-(count - WINDOW) // STRIDE), 0) + 1, 0)
    owner = np.repeat(np.arange(rows), each)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    base = np.cumsum(count) - count
    place = (base[owner] + nth * STRIDE)[:, None] + np.arange(WINDOW)
    real = place < (base + count)[owner][:, None]
    filled = np.where(real, words.number[np.minimum(place, max(0, len(words.number) - 1))] if len(words.number) else 0, len(words.hashes))
    return filled.astype(np.int32), real, owner


def _summary(logits: np.ndarray, owner: np.ndarray, rows: int, lowest: float) -> np.ndarray:
    """Highest, second highest and mean logit of each row's windows."""
    out = np.full((rows, 3), lowest)
    if len(owner):
        order = np.lexsort((-logits, owner))
        sorted_owner = owner[order]
        head = np.flatnonzero(np.r_[True, sorted_owner[1:] != sorted_owner[:-1]])
        own = sorted_owner[head]
        size = np.diff(np.r_[head, len(owner)])
        out[own, 0] = logits[order][head]
        out[own, 1] = np.where(size > 1, logits[order][np.minimum(head + 1, len(owner) - 1)], lowest)
        out[own, 2] = np.add.reduceat(logits[order], head) / size
    return np.clip(out, lowest, -lowest)


@dataclass
class Model:
    """What scoring needs; a few MB, whatever the corpus."""

    prior: float
    word_odds: np.ndarray | None = None
    gram_odds: np.ndarray | None = None
    net: recurrent.Network | None = None
    final: np.ndarray | None = None
    lowest: float = -12.0

    def logits(self, words: Words, filled: np.ndarray, real: np.ndarray) -> np.ndarray:
        table = self.net.table(_features(words, self.word_odds, self.gram_odds))
        return np.concatenate([np.zeros(0, F32), *[self.net.logits(table, filled[i : i + 2048], real[i : i + 2048]) for i in range(0, len(filled), 2048)]])

    def score(self, column: pa.Array) -> np.ndarray:
        if self.net is None:
            return np.full(len(column), self.prior)
        words = read_words(column)
        filled, real, owner = windows(words, len(column))
        x = _summary(self.logits(words, filled, real), owner, len(column), self.lowest)
        return 1 / (1 + np.exp(-np.clip(x @ self.final[:-1] + self.final[-1], -30, 30)))


def train(data: Sample, rounds: int = 3, epochs: int = 3, seed: int = 0) -> Model:
    """Fit the network, and the regression over a document's windows, on labelled texts."""
    y, weight = np.array(data.labels, np.int64), np.array(data.weights)
    if len(set(data.labels)) < 2:
        return Model(float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    column = pa.array(data.texts, pa.large_string())
    words = read_words(column)
    filled, real, owner = windows(words, len(y))
    # equal texts share a part, so that a copy never tells on its twin
    texts = {t: i for i, t in enumerate(dict.fromkeys(data.texts))}
    part = np.array([texts[t] for t in data.texts]) % PARTS
    word_odds, gram_odds = Odds(part, y, weight), Odds(part, y, weight)
    bounds = np.searchsorted(words.row, np.arange(0, len(y) + 64, 64))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        pairs = np.unique(words.row[lo:hi].astype(np.int64) * len(words.hashes) + words.number[lo:hi])
        doc, word = pairs // len(words.hashes), pairs % len(words.hashes)
        word_odds.add(doc, (words.hashes[word] >> U64(64 - BITS)).astype(np.int64))
        reps = np.diff(words.gram_at)[word]
        gram_odds.add(np.repeat(doc, reps), words.gram[np.repeat(words.gram_at[:-1][word], reps) + np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)])

    def tables(without: int | None) -> tuple[np.ndarray, np.ndarray]:
        return word_odds.table(without, 2.0), gram_odds.table(without, 4.0)

    pile = np.concatenate([_features(words, *tables(k)) for k in range(PARTS)])
    shifted = filled + (part[owner] * (len(words.hashes) + 1))[:, None].astype(np.int32)
    net = recurrent.Network(pile.shape[1], seed=seed)
    hint = np.maximum(pile[:, 0], 0) + np.maximum(pile[:, 1], 0)
    guess = (hint[shifted] * real).sum(axis=1)
    adam = recurrent.Adam(net.p, 0.02)
    for turn in range(rounds):
        order = np.lexsort((-guess, owner))
        rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        chosen = order[rank < np.where(y[owner[order]] == 1, 2, 3)]
        clean = np.flatnonzero(y[owner] == 0)
        if len(clean):
            chosen = np.r_[chosen, rng.choice(clean, min(len(clean), 2000), replace=False)]
        goal = y[owner[chosen]].astype(F32)
        w = np.where(goal == 1, 0.5 / max(1, goal.sum()), 0.5 / max(1, (1 - goal).sum())).astype(F32)
        for epoch in range(epochs):
            adam.rate = 0.02 if turn + 1 < rounds else 0.006
            mixed = rng.permutation(len(chosen))
            for i in range(0, len(mixed), 128):
                z = mixed[i : i + 128]
                _, g = net.gradients(pile, shifted[chosen[z]], real[chosen[z]], goal[z], w[z] * len(chosen))
                norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
                adam.step({k: x * F32(min(1.0, 1 / max(norm, 1e-9))) for k, x in g.items()})
        table = net.table(pile)
        guess = np.concatenate([net.logits(table, shifted[i : i + 2048], real[i : i + 2048]) for i in range(0, len(shifted), 2048)])
    out = Model(float((y * weight).sum() / weight.sum()), *tables(None), net)
    x = _summary(guess, owner, len(y), out.lowest)
    out.final = recurrent.logistic(x, y, weight, ridge=1e-2)
    return out


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = pickle.loads(model.value)
        for block in blocks(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(own.score(block.column(block.schema.names.index("text"))))], names=[*block.schema.names, "score"])

    return run


def score_with(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (with text) with ``score``; a map over whole texts, all other columns unchanged."""
    docs = docs.select(*[c for c in docs.columns if c != "score"])
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(tidy(_score(sent)), f"{kinds}, score double")


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    """Train on labelled documents outside the held-out fold, and score all of ``docs`` (doc_id, text, ...)."""
    model = train(sample(docs, labels, label, per_class=per_class))
    release()
    return score_with(docs, model)
