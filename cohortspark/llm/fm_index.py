"""FM-index over a sequence of small integers: suffix order, wavelet-matrix ranks, backward search, sampled positions.

Symbol 0 is a break. Every break counts as a symbol of its own, smaller than all others and ordered by position, so no match
crosses one and suffixes differ at the first break at the latest. All operations work on arrays of rows at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes: sort by three symbols, then double the depth within ties.

    `seq` ends with a break. A suffix with a break inside the sorted depth is settled, by position among equals.
    """
    n = len(seq)
    s = np.concatenate([seq, np.zeros(2, seq.dtype)]).astype(np.int64)
    a, b, c = s[:n], s[1 : n + 1], s[2 : n + 2]
    b = np.where(a == 0, 0, b)
    c = np.where(b == 0, 0, c)
    key = (a << 42) | (b << 21) | c
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.ones(n, bool)
    first[1:] = (key[1:] != key[:-1]) | (c[order[1:]] == 0)
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    depth = 3
    while True:
        alone = first & np.append(first[1:], True)
        rows = np.flatnonzero(~alone)
        if not len(rows):
            return order
        at = order[rows]
        pair = rank[at] * n + rank[at + depth]
        by = np.argsort(pair, kind="stable")
        at, pair = at[by], pair[by]
        order[rows] = at
        new = np.ones(len(rows), bool)
        new[1:] = pair[1:] != pair[:-1]
        first[rows] = new
        rank[at] = rows[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
        depth *= 2


class Wavelet:
    """Wavelet matrix: one bit vector a level, most significant bit first, with a count of ones before each 64-bit word."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.words, self.ones, self.zeros = [], [], []
        v = values.astype(np.uint32)
        n = len(v)
        for level in range(self.levels - 1, -1, -1):
            bit = (v >> level) & 1
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view(np.uint64)
            self.words.append(words)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(n - int(self.ones[-1][-1]))
            v = np.concatenate([v[bit == 0], v[bit == 1]])
        every = np.arange(symbols)
        self.first = self._down(every, np.zeros(symbols, np.int64))

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.ones[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            ones = self._ones(level, i)
            i = np.where((symbol >> (self.levels - 1 - level)) & 1, self.zeros[level] + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often `symbol` occurs before place `i`."""
        return self._down(symbol, i) - self.first[symbol]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place `i`, and how often it occurs before."""
        symbol = np.zeros(len(i), np.int64)
        for level in range(self.levels):
            bit = (self.words[level][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)
            ones = self._ones(level, i)
            symbol = (symbol << 1) | bit.astype(np.int64)
            i = np.where(bit == 1, self.zeros[level] + ones, i - ones)
        return symbol, i - self.first[symbol]


class FmIndex:
    def __init__(self, seq: np.ndarray, symbols: int, sample: int = SAMPLE):
        order = suffix_order(seq)
        before = seq[order - 1]
        self.n = len(seq)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols))])
        self.ranks = Wavelet(before, symbols)
        # A walk back must not pass a break, so the positions behind breaks are sampled besides every `sample`-th.
        self.kept = (order % sample == 0) | (before == 0)
        self.kept_before = np.cumsum(self.kept) - self.kept
        self.positions = order[self.kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each phrase (a row of symbols), found backwards; empty where the phrase does not occur."""
        count, length = phrases.shape
        low, high = np.zeros(count, np.int64), np.full(count, self.n, np.int64)
        alive = np.arange(count)
        for k in range(length - 1, -1, -1):
            symbol = phrases[alive, k]
            both = self.ranks.rank(np.concatenate([symbol, symbol]), np.concatenate([low[alive], high[alive]]))
            low[alive] = self.start[symbol] + both[: len(alive)]
            high[alive] = self.start[symbol] + both[len(alive) :]
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of each row's suffix: step back to the next sampled one."""
        found = np.empty(len(rows), np.int64)
        open_ = np.arange(len(rows))
        steps = 0
        while len(open_):
            done = self.kept[rows]
            found[open_[done]] = self.positions[self.kept_before[rows[done]]] + steps
            open_, rows = open_[~done], rows[~done]
            symbol, before = self.ranks.access(rows)
            rows = self.start[symbol] + before
            steps += 1
        return found
