"""An FM-index over whole-number symbols: wavelet-tree ranks over the Burrows-Wheeler transform, sampled positions.

The text is a sequence of blocks, each ended by the symbol 0. Every terminator counts as a symbol of
its own (ordered by place), so all suffixes differ, none is compared beyond its block, and the sort
ends after log2(block length) doublings whatever repeats the text holds.
"""

from __future__ import annotations

import numpy as np


def sort_suffixes(text: np.ndarray, sigma: int) -> np.ndarray:
    """The suffix array of ``text``; symbols are 0 (terminator) to ``sigma``, the last symbol is 0."""
    n, bits = len(text), max(1, int(sigma).bit_length())
    width = max(1, 62 // bits)
    ends = np.flatnonzero(text == 0)
    to_end = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # symbols before the block's terminator
    key = np.zeros(n, np.int64)
    padded = np.concatenate([text.astype(np.int64), np.zeros(width, np.int64)])
    for i in range(width):
        key = key << bits | np.where(to_end >= i, padded[i : i + n], 0)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    # Suffixes that end within the key are told apart by their terminators, which the stable sort has put in order.
    tied = np.zeros(n, bool)
    tied[1:] = (ordered[1:] == ordered[:-1]) & (to_end[order[1:]] >= width)
    rank = np.empty(n, np.int64)
    first = np.maximum.accumulate(np.where(tied, 0, np.arange(n)))
    rank[order] = first
    depth = width
    while tied.any():
        open_ = tied.copy()
        open_[:-1] |= tied[1:]
        slots = np.flatnonzero(open_)
        part = order[slots]
        high, low = rank[part], rank[part + depth]
        by = np.lexsort((low, high))
        order[slots] = part[by]
        high, low = high[by], low[by]
        same = np.zeros(len(slots), bool)
        same[1:] = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
        tied = np.zeros(n, bool)
        tied[slots] = same
        rank[order[slots]] = np.maximum.accumulate(np.where(same, 0, slots))
        depth *= 2
    return order


class WaveletTree:
    """Rank and access over a sequence, one bit plane per level, most significant bit first."""

    def __init__(self, sequence: np.ndarray, sigma: int):
        self.n, self.levels = len(sequence), max(1, int(sigma).bit_length())
        self.words, self.before, self.zeros = [], [], []
        row = sequence.astype(np.int64)
        for level in range(self.levels):
            bit = (row >> (self.levels - 1 - level) & 1).astype(bool)
            packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
            packed[: (self.n + 7) // 8] = np.packbits(bit, bitorder="little")
            words = packed.view(np.uint64)
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append(np.cumsum(ones) - ones)
            self.zeros.append(self.n - int(bit.sum()))
            row = np.concatenate([row[~bit], row[bit]])
        symbols = np.arange(sigma + 1)
        self.base = self._down(symbols, np.zeros(sigma + 1, np.int64))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[level][word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[level][word] + np.bitwise_count(low)

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            ones = self._ones(level, at)
            bit = symbol >> (self.levels - 1 - level) & 1
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbol, at) - self.base[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the places, and how often each occurs before its place."""
        symbol = np.zeros(len(at), np.int64)
        for level in range(self.levels):
            ones = self._ones(level, at)
            bit = (self.words[level][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)
            symbol = symbol << 1 | bit
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return symbol, at - self.base[symbol]


class FMIndex:
    """Finds all occurrences of many patterns in ``text`` (blocks of symbols from 1 to ``sigma``, each ended by 0)."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = 8):
        order = sort_suffixes(text, sigma)
        self.n = len(text)
        last = text[order - 1]  # the symbol before position 0 is the final terminator
        self.tree = WaveletTree(last, sigma)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 1))])
        sampled = (order % sample == 0) | (last == 0)  # block starts too, so no walk crosses a terminator
        self.samples = WaveletTree(sampled.astype(np.int64), 1)
        self.positions = order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range of each pattern; row i of ``patterns`` has ``lengths[i]`` symbols, right-aligned."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for step in range(patterns.shape[1]):
            on = np.flatnonzero((lengths > step) & (low < high))
            if not on.size:
                break
            symbol = patterns[on, patterns.shape[1] - 1 - step].astype(np.int64)
            low[on] = self.less[symbol] + self.tree.rank(symbol, low[on])
            high[on] = self.less[symbol] + self.tree.rank(symbol, high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the given suffix rows, by steps back to the nearest sampled position."""
        rows = rows.astype(np.int64)
        out, steps, open_ = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        one = np.ones(1, np.int64)
        while open_.size:
            is_sampled, _ = self.samples.access(rows)
            done = is_sampled == 1
            index = self.samples.rank(np.broadcast_to(one, int(done.sum())), rows[done])
            out[open_[done]] = self.positions[index] + steps
            open_, rows = open_[~done], rows[~done]
            symbol, before = self.tree.access(rows)
            rows = self.less[symbol] + before
            steps += 1
        return out
