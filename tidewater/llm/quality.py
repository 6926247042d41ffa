"""Document quality from a linear-chain conditional random field over lines.

Every line of a text (split at line feeds; white-space lines are left out) is
labelled good or bad.  A line's features are its own and those of the lines
before and after it; the chain adds how labels follow each other.  Forward and
backward passes give each line's probability of being good; weighted by the
lines' lengths they are the document's share of good text, which a logistic
regression maps to the score.

Only documents are labelled.  Training starts with each line bearing its
document's label; in two more rounds lines of bad documents that the field holds
for good are relabelled, but never all of a document.  The field is fitted on a
bounded sample (labelled.PER_CLASS rows of each class).

Null, empty and white-space texts have no line; their share of good text is 0.
Without labels of both classes every score is the share of label 1 (0 if there
are none).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .labelled import Sample, sample
from .recurrent import Adam, logistic
from .textbuf import LOWER, NOT_SPACE, blocks, chunk_word_hashes, flat, release, tidy

LINE = np.ones(256, dtype=bool)
LINE[0x0A] = False


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for lo, hi in ranges:
        out[lo : hi + 1] = 1
    return out


#: Classes of bytes whose shares of a line are features.
CLASSES = [
    _class((0x61, 0x7A)),
    _class((0x41, 0x5A)),
    _class((0x30, 0x39)),
    _class((0x80, 0xFF)),
    _class((0x20, 0x20), (0x09, 0x0D)),
    _class((0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F), (0x27, 0x29), (0x2D, 0x2D), (0x22, 0x22)),
    _class((0x21, 0x21)),
    _class((0x23, 0x26), (0x2A, 0x2B), (0x5E, 0x5E), (0x7E, 0x7E), (0x40, 0x40)),
    _class((0x7C, 0x7C), (0x5B, 0x5D), (0x7B, 0x7B), (0x7D, 0x7D), (0x3C, 0x3E), (0x5F, 0x5F), (0x2F, 0x2F)),
    _class((0x00, 0x08), (0x0E, 0x1F), (0x7F, 0x7F)),
]


@dataclass
class Lines:
    """Rows, lengths and features of the lines of some texts, in order."""

    row: np.ndarray
    length: np.ndarray
    x: np.ndarray


def read_lines(column: pa.Array) -> Lines:
    buf, offs = flat(column)
    starts, ends, rows, whole = chunk_word_hashes(buf, offs, LINE)
    ws, we, _, wh = chunk_word_hashes(LOWER[buf], offs, NOT_SPACE)
    of = np.searchsorted(starts, ws, "right") - 1
    count = np.bincount(of, minlength=len(starts))
    keep = count > 0
    new = np.cumsum(keep) - 1
    starts, ends, rows, whole, count, of = starts[keep], ends[keep], rows[keep], whole[keep], count[keep], new[of]
    n, length = len(starts), ends - starts
    own = np.zeros((n, len(CLASSES) + 9), np.float32)
    if n:
        for i, members in enumerate(CLASSES):
            sums = np.r_[0, np.cumsum(members[buf], dtype=np.int64)]
            own[:, i] = (sums[ends] - sums[starts]) / length
        k = len(CLASSES)
        own[:, k] = np.log1p(length) / 8
        own[:, k + 1] = np.log1p(count) / 6
        own[:, k + 2] = np.minimum(np.bincount(of, we - ws, n) / count, 20) / 10
        same = np.r_[False, (wh[1:] == wh[:-1]) & (of[1:] == of[:-1])]
        own[:, k + 3] = np.bincount(of, same, n) / count
        order = np.lexsort((wh, of))
        fresh = np.r_[True, (of[order][1:] != of[order][:-1]) | (wh[order][1:] != wh[order][:-1])]
        own[:, k + 4] = np.bincount(of[order], fresh, n) / count
        own[:, k + 5] = own[:, k + 4] ** 2
        last = buf[ends - 1]
        own[:, k + 6] = (last == 0x2E) | (last == 0x3F) | (last == 0x21)
        order = np.lexsort((whole, rows))
        again = np.r_[False, (rows[order][1:] == rows[order][:-1]) & (whole[order][1:] == whole[order][:-1])]
        seen = np.zeros(n, bool)
        seen[order] = again | np.r_[again[1:], False]
        own[:, k + 7] = seen
        own[:, k + 8] = np.bincount(of, (we - ws) == 1, n) / count
    before = np.zeros_like(own)
    after = np.zeros_like(own)
    if n:
        linked = np.flatnonzero(rows[1:] == rows[:-1])
        before[linked + 1], after[linked] = own[linked], own[linked + 1]
        edge = np.ones((n, 2), np.float32)
        edge[linked + 1, 0], edge[linked, 1] = 0, 0
    else:
        edge = np.zeros((0, 2), np.float32)
    return Lines(rows, length, np.c_[own, before, after, edge, np.ones((n, 1), np.float32)])


class Field:
    """Two labels (0 bad, 1 good): a weight vector for good against bad, and a score for each pair of neighbours."""

    def __init__(self, features: int):
        self.p = {"w": np.zeros(features), "t": np.zeros((2, 2))}

    def marginals(self, lines: Lines, scores: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
        """Each line's probability of being good, probabilities of each neighbour pair's labels, and the sum of log partition functions.

        All documents go forward and backward together, line by line; those with
        fewer lines drop out.
        """
        e = (lines.x @ self.p["w"] if scores is None else scores).astype(np.float64)
        if not len(e):
            return e, np.zeros((0, 2, 2)), 0.0
        e = np.stack([np.zeros(len(e)), e], axis=1)
        first = np.flatnonzero(np.r_[True, lines.row[1:] != lines.row[:-1]])
        size = np.diff(np.r_[first, len(lines.row)])
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        t = self.p["t"]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        live = np.searchsorted(-size, -np.arange(size[0]), "left")  # documents with more lines than k
        alpha[first] = e[first]
        for k in range(1, size[0]):
            at = first[: live[k]] + k
            alpha[at] = np.logaddexp(alpha[at - 1, :1] + t[0], alpha[at - 1, 1:] + t[1]) + e[at]
        for k in range(size[0] - 2, -1, -1):
            at = first[: live[k + 1]] + k
            y = e[at + 1] + beta[at + 1]
            beta[at] = np.logaddexp(t[:, 0] + y[:, :1], t[:, 1] + y[:, 1:])
        ends = first + size - 1
        z = np.logaddexp(alpha[ends, 0], alpha[ends, 1])
        whole = np.repeat(z[np.argsort(first)], size[np.argsort(first)])
        good = np.exp(alpha[:, 1] + beta[:, 1] - whole)
        linked = np.flatnonzero(lines.row[1:] == lines.row[:-1])
        if len(linked):
            y = e[linked + 1] + beta[linked + 1]
            pairs = np.exp(alpha[linked][:, :, None] + t + y[:, None, :] - whole[linked][:, None, None])
        else:
            pairs = np.zeros((0, 2, 2))
        return good, pairs, float(z.sum())

    def fit(self, lines: Lines, good: np.ndarray, weight: np.ndarray, rounds: int = 150, ridge: float = 1e-3) -> None:
        """Maximise the conditional likelihood of line labels; ``weight`` is that of a line's document."""
        adam = Adam(self.p, 0.1)
        linked = np.flatnonzero(lines.row[1:] == lines.row[:-1])
        total = weight.sum()
        seen = np.zeros((2, 2))
        np.add.at(seen, (good[linked], good[linked + 1]), weight[linked])
        for k in range(rounds):
            adam.rate = 0.1 if k < rounds // 2 else 0.03
            p, pairs, _ = self.marginals(lines)
            g = {"w": ((p - good) * weight) @ lines.x / total + ridge * self.p["w"], "t": ((pairs * weight[linked][:, None, None]).sum(axis=0) - seen) / total + ridge * self.p["t"]}
            adam.step(g)


def _shares(lines: Lines, good: np.ndarray, rows: int) -> np.ndarray:
    """Length-weighted share of good text and its log-odds."""
    size = np.bincount(lines.row, lines.length, rows)
    share = np.where(size > 0, np.bincount(lines.row, lines.length * good, rows) / np.maximum(size, 1), 0)
    c = np.clip(share, 1e-3, 1 - 1e-3)
    return np.stack([share, np.log(c / (1 - c)) / 7], axis=1)


@dataclass
class Model:
    prior: float
    field: Field | None = None
    final: np.ndarray | None = None

    def line_marginals(self, column: pa.Array) -> tuple[Lines, np.ndarray]:
        lines = read_lines(column)
        return lines, self.field.marginals(lines)[0]

    def score(self, column: pa.Array) -> np.ndarray:
        if self.field is None:
            return np.full(len(column), self.prior)
        x = _shares(*self.line_marginals(column), len(column))
        return 1 / (1 + np.exp(-np.clip(x @ self.final[:-1] + self.final[-1], -30, 30)))


def train(data: Sample, rounds: int = 3) -> Model:
    y, weight = np.array(data.labels, np.int64), np.array(data.weights)
    if len(set(data.labels)) < 2:
        return Model(float(y.mean()) if len(y) else 0.0)
    lines = read_lines(pa.array(data.texts, pa.large_string()))
    good = y[lines.row]
    # a document weighs the same whatever its number of lines, and both classes the same
    per_class = np.bincount(y, minlength=2)
    w = 1 / np.maximum(np.bincount(lines.row, minlength=len(y)), 1)[lines.row] / per_class[y[lines.row]]
    field = Field(lines.x.shape[1])
    for turn in range(rounds):
        field.fit(lines, good, w)
        p = field.marginals(lines)[0]
        if turn + 1 < rounds:
            worst = np.full(len(y), 2.0)
            np.minimum.at(worst, lines.row, p)
            good = np.where(y[lines.row] == 1, 1, ((p > 0.8) & (p > worst[lines.row])).astype(np.int64))
    out = Model(float((y * weight).sum() / weight.sum()), field)
    out.final = logistic(_shares(lines, p, len(y)), y, weight, ridge=1e-4)
    return out


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = pickle.loads(model.value)
        for block in blocks(batches, "text", 4 << 20):
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(own.score(block.column(block.schema.names.index("text"))))], names=[*block.schema.names, "score"])

    return run


def score_with(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (with text) with ``score``; a map over whole texts, all other columns unchanged."""
    docs = docs.select(*[c for c in docs.columns if c != "score"])
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(tidy(_score(sent)), f"{kinds}, score double")


def _mark(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = pickle.loads(model.value)
        for block in blocks(batches, "text", 4 << 20):
            lines, good = own.line_marginals(block.column(block.schema.names.index("text")))
            counts = np.bincount(lines.row, minlength=block.num_rows)
            found = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(good))
            yield pa.RecordBatch.from_arrays([*block.columns, found], names=[*block.schema.names, "good_lines"])

    return run


def mark_lines(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``good_lines``: for each line that isn't white space, the probability that it is good."""
    docs = docs.select(*[c for c in docs.columns if c != "good_lines"])
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(tidy(_mark(sent)), f"{kinds}, good_lines array<double>")


def score(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Train on labelled documents outside the held-out fold, and score all of ``docs`` (doc_id, text, ...)."""
    model = train(sample(docs, labels, label))
    release()
    return score_with(docs, model)
