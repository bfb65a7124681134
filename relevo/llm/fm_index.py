"""FM-index of one shard's symbols: Burrows-Wheeler transform, wavelet matrix
for ranks, and suffix positions sampled at a fixed rate.  All operations work
on arrays of patterns or rows at once."""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; the last symbol is the unique least."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-width or None] = rank[width:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        width *= 2
        if rank[order[-1]] == n - 1 or width >= n:
            return order


class FMIndex:
    """Index of ``seq`` (symbols from 1 up; 0 is the end mark added here)."""

    def __init__(self, seq: np.ndarray, rate: int = 16):
        seq = np.append(np.asarray(seq, np.int64), 0)
        self.n, self.rate = len(seq), rate
        order = suffix_array(seq)
        bwt = seq[order - 1]
        self.sigma = int(seq.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=self.sigma))])
        # wavelet matrix: for every bit, ones before each place, and the zeros
        self.levels = []
        for bit in reversed(range(max(1, (self.sigma - 1).bit_length()))):
            ones = (bwt >> bit) & 1
            self.levels.append((bit, np.concatenate([[0], np.cumsum(ones)]), int(self.n - ones.sum())))
            bwt = np.concatenate([bwt[ones == 0], bwt[ones == 1]])
        marked = order % rate == 0
        self.marked = marked
        self.samples = order[marked]
        self.samples_before = np.concatenate([[0], np.cumsum(marked)])

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the first ``row`` places of the BWT."""
        base = np.zeros_like(row)
        for bit, ones, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            row = np.where(one, zeros + ones[row], row - ones[row])
            base = np.where(one, zeros + ones[base], base - ones[base])
        return row - base

    def step_back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one symbol earlier."""
        symbol, at, base = np.zeros_like(row), row, np.zeros_like(row)
        for _, ones, zeros in self.levels:
            one = ones[at + 1] > ones[at]
            symbol = symbol * 2 + one
            at = np.where(one, zeros + ones[at], at - ones[at])
            base = np.where(one, zeros + ones[base], base - ones[base])
        return self.before[symbol] + at - base

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [low, high) of each pattern (one row of the array each);
        symbols must not exceed the alphabet."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.n)
        for symbol in patterns.T[::-1]:
            low = self.before[symbol] + self.rank(symbol, low)
            high = self.before[symbol] + self.rank(symbol, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, walked back to the next sampled suffix."""
        found, left, steps, rows = np.empty(len(rows), np.int64), np.arange(len(rows)), 0, rows.copy()
        while len(left):
            hit = self.marked[rows]
            found[left[hit]] = self.samples[self.samples_before[rows[hit]]] + steps
            left, rows = left[~hit], self.step_back(rows[~hit])
            steps += 1
        return found
