"""A compressed full-text index: Burrows-Wheeler transform in a wavelet matrix, backward search."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Bits in 64-bit words with a running count per word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.pad(packed, (0, -len(packed) % 8 + 8)).view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words))].astype(np.uint32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        part = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word].astype(np.int64) + np.bitwise_count(part)


class WaveletMatrix:
    """Counts of a symbol before a position, in one bit vector per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray):
        self.levels = max(1, int(symbols.max()).bit_length()) if len(symbols) else 1
        self.vectors, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (symbols >> level) & 1
            vector = BitVector(bit.astype(bool))
            self.vectors.append(vector)
            self.zeros.append(len(bit) - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        begin = np.zeros(len(symbol), np.int64)
        for level, vector, zeros in zip(range(self.levels - 1, -1, -1), self.vectors, self.zeros):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = vector.ones(begin), vector.ones(at)
            begin = np.where(one, zeros + a, begin - a)
            at = np.where(one, zeros + b, at - b)
        return at - begin


class FMIndex:
    """Index of a sequence of small numbers that ends with a 0, for patterns of up to ``depth`` symbols.

    Suffixes are sorted by their first ``depth`` symbols (by prefix doubling), which is all that
    a backward search of so many steps needs.
    """

    def __init__(self, symbols: np.ndarray, depth: int):
        n = len(symbols)
        rank, width = symbols.astype(np.int64), 1
        while width < depth:
            follow = np.zeros(n, np.int64)
            follow[: n - width] = rank[width:] + 1 if n > width else 0
            key = rank * (int(follow.max(initial=0)) + 1) + follow
            _, rank = np.unique(key, return_inverse=True)
            width *= 2
        self.order = np.argsort(rank, kind="stable")
        self.counts = np.r_[0, np.cumsum(np.bincount(symbols, minlength=int(symbols.max(initial=0)) + 1))]
        self.transform = WaveletMatrix(symbols[self.order - 1])

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(length, begin, end) for the rows of ``patterns``: the length of the longest suffix of each
        that occurs, and its places in sorted order. All rows step back together; a row whose
        interval becomes empty stops."""
        n, m = patterns.shape
        begin, end = np.zeros(n, np.int64), np.full(n, len(self.order), np.int64)
        length, live = np.zeros(n, np.int64), np.arange(n)
        for step in range(m - 1, -1, -1):
            symbol = patterns[live, step]
            base = self.counts[symbol]
            a = base + self.transform.rank(symbol, begin[live])
            b = base + self.transform.rank(symbol, end[live])
            go = a < b
            live, a, b = live[go], a[go], b[go]
            begin[live], end[live] = a, b
            length[live] += 1
            if not len(live):
                break
        return length, begin, end


class RangeMinimum:
    """Smallest value of any range, from the minima of ranges of doubling sizes."""

    def __init__(self, values: np.ndarray):
        self.rows, size = [values], 1
        while size * 2 <= len(values):
            have = self.rows[-1]
            self.rows.append(np.minimum(have[:-size], have[size:]))
            size *= 2

    def query(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        level = np.frexp((end - begin).astype(np.float64))[1] - 1
        out = np.empty(len(begin), self.rows[0].dtype)
        for k in np.unique(level).tolist():
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[begin[at]], row[end[at] - (1 << k)])
        return out
