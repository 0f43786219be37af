"""An FM-index over a sequence of small non-negative integers, in numpy.

Many patterns are searched at once: every step of the backward search is one rank query
per pattern that still has occurrences.
"""

from __future__ import annotations

import numpy as np


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, a shorter suffix first, by prefix doubling."""
    n = len(values)
    _, rank = np.unique(values, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    width = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: max(n - width, 0)] = rank[width:]
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        own = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], (own[1:] != own[:-1]).astype(np.int64)]))[:n]
        width *= 2
        if n == 0 or rank[order[-1]] == n:
            return order


class WaveletRanks:
    """Ranks of symbols in a sequence, from one bit vector per bit of a symbol."""

    def __init__(self, values: np.ndarray, symbols: int) -> None:
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.bits)):
            bit = (values >> level) & 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(int(len(values) - ones[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.bits - 1 - k)) & 1
            one = ones[at].astype(np.int64)
            at = np.where(bit == 1, zeros + one, at - one)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._descend(symbol, at) - self._descend(symbol, np.zeros_like(at))


class FMIndex:
    """Index of ``values`` (0 to symbols - 1); every ``sample``-th place is stored."""

    def __init__(self, values: np.ndarray, symbols: int, sample: int = 8) -> None:
        # A closing sentinel below every symbol: the symbols move up by one.
        text = np.append(values.astype(np.int64) + 1, 0)
        order = suffix_array(text)
        self.n = len(text)
        self.last = text[order - 1]
        self.ranks = WaveletRanks(self.last, symbols + 1)
        counts = np.bincount(text, minlength=symbols + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.marked = order % sample == 0
        self.mark_rank = np.concatenate([[0], np.cumsum(self.marked)])
        self.places = order[self.marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that begin with each pattern.

        ``patterns`` holds one pattern per row, aligned to the right.
        """
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.n, np.int64)
        width = patterns.shape[1]
        for step in range(width):
            live = np.flatnonzero((lo < hi) & (step < lengths))
            if not len(live):
                break
            symbol = patterns[live, width - 1 - step].astype(np.int64) + 1
            begin = self.before[symbol]
            lo[live] = begin + self.ranks.rank(symbol, lo[live])
            hi[live] = begin + self.ranks.rank(symbol, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of the given rows: steps back to a stored place."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.marked[rows])
        while len(walking):
            own = rows[walking]
            symbol = self.last[own]
            rows[walking] = self.before[symbol] + self.ranks.rank(symbol, own)
            steps[walking] += 1
            walking = walking[~self.marked[rows[walking]]]
        return self.places[self.mark_rank[rows]] + steps
