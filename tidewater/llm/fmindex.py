"""A full-text index (FM-index) over a sequence of integers, built and searched with numpy.

All queries are vectorised over patterns: one backward step is a handful of
array reads, whatever the number of patterns.
"""

from __future__ import annotations

import numpy as np


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by prefix doubling; suffixes that already stand alone aren't sorted again."""
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(s, kind="stable")
    head = np.r_[True, s[order][1:] != s[order][:-1]]
    rank = np.empty(n, np.int64)
    # a suffix's rank is the place of the first one of its group
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = 1
    while True:
        alone = head & np.r_[head[1:], True]
        open_at = np.flatnonzero(~alone)
        if not len(open_at):
            return order
        left = order[open_at]
        after = left + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[left]
        by = np.lexsort((second, first))
        left, first, second = left[by], first[by], second[by]
        order[open_at] = left
        fresh = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        head[open_at] = fresh
        rank[left] = open_at[np.maximum.accumulate(np.where(fresh, np.arange(len(left)), 0))]
        step *= 2


class Wavelet:
    """Wavelet tree, level by level from the highest bit, over numbers below ``size``."""

    def __init__(self, s: np.ndarray, size: int):
        self.levels = range(max(1, int(size - 1).bit_length()) - 1, -1, -1)
        self.ones, self.zeros = [], []
        for level in self.levels:
            bit = (s >> level) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int32))
            self.zeros.append(len(s) - int(self.ones[-1][-1]))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before ``at``."""
        start = np.zeros_like(at)
        for level, ones, zeros in zip(self.levels, self.ones, self.zeros, strict=True):
            up = ((symbol >> level) & 1) == 1
            a, b = ones[start], ones[at]
            start = np.where(up, zeros + a, start - a)
            at = np.where(up, zeros + b, at - b)
        return at - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at ``at`` and how often each stands before."""
        start, symbol = np.zeros_like(at), np.zeros_like(at)
        for level, ones, zeros in zip(self.levels, self.ones, self.zeros, strict=True):
            a, b = ones[start], ones[at]
            up = ones[at + 1] > b
            symbol |= up.astype(symbol.dtype) << level
            start = np.where(up, zeros + a, start - a)
            at = np.where(up, zeros + b, at - b)
        return symbol, at - start


class FMIndex:
    """Backward search over numbers from 1 to ``size - 1`` (0 is for separators); every ``sample``-th suffix keeps its position."""

    def __init__(self, s: np.ndarray, size: int, sample: int = 8):
        s = np.r_[s + 1, 0].astype(np.int64)  # 0 ends the text
        self.n, size = len(s), size + 1
        order = suffix_array(s)
        self.before = np.r_[0, np.cumsum(np.bincount(s, minlength=size))]
        self.tree = Wavelet(s[order - 1], size)
        marked = order % sample == 0
        self.marked = np.r_[0, np.cumsum(marked)]
        self.places = order[marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last row of each pattern (row i holds ``lengths[i]`` numbers, left-aligned)."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for back in range(1, patterns.shape[1] + 1 if len(patterns) else 1):
            live = np.flatnonzero((lengths >= back) & (lo < hi))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - back] + 1
            lo[live] = self.before[symbol] + self.tree.rank(symbol, lo[live])
            hi[live] = self.before[symbol] + self.tree.rank(symbol, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back through the text to a sampled one."""
        out, at, steps, left = np.empty(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(left):
            hit = self.marked[at + 1] > self.marked[at]
            out[left[hit]] = self.places[self.marked[at[hit]]] + steps
            left, at = left[~hit], at[~hit]
            symbol, before = self.tree.access(at)
            at = self.before[symbol] + before
            steps += 1
        return out
