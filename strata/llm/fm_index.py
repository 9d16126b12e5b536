"""FM-index over sequences of small integers: suffix array, wavelet-matrix BWT, backward search, sampled positions.

All operations take arrays of queries and advance them together.
"""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of all suffixes (a shorter one first) by prefix doubling; only undecided groups are sorted again."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = seq[order[1:]] != seq[order[:-1]]
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    width = 1
    while True:
        # members of groups with more than one suffix
        start = np.flatnonzero(new)
        sizes = np.diff(np.append(start, n))
        open_at = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if not len(open_at):
            return order
        members = order[open_at]
        ahead = members + width
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        by = np.lexsort((follow, rank[members]))
        members, follow = members[by], follow[by]
        order[open_at] = members
        group = rank[members]
        split = np.ones(len(members), bool)
        split[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        new[open_at] = split
        rank[members] = np.maximum.accumulate(np.where(split, open_at, 0))
        width *= 2


class Bits:
    """A bit vector packed into 64-bit words with counts of ones before each word."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros((self.n >> 6) + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.concatenate([[0], np.cumsum(ones[:-1], dtype=np.uint32)]).astype(np.uint32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word].astype(np.int64) + np.bitwise_count(low)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits: list[Bits] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.levels)):
            bit = ((seq >> level) & 1).astype(bool)
            self.bits.append(Bits(bit))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the first i positions of each symbol end in the last level; differences give ranks."""
        for k, (bits, zeros) in enumerate(zip(self.bits, self.zeros, strict=True)):
            one = ((symbol >> (self.levels - 1 - k)) & 1).astype(bool)
            ranked = bits.rank(i)
            i = np.where(one, zeros + ranked, i - ranked)
        return i

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and where that position ends in the last level."""
        symbol = np.zeros(len(i), np.int64)
        for bits, zeros in zip(self.bits, self.zeros, strict=True):
            one, ranked = bits.get(i), bits.rank(i)
            symbol = (symbol << 1) | one
            i = np.where(one, zeros + ranked, i - ranked)
        return symbol, i


class FMIndex:
    """Index of ``seq`` (values 1 .. sigma - 1; 0 is kept for the end mark). ``sample`` keeps every k-th text position."""

    def __init__(self, seq: np.ndarray, sigma: int, sample: int = 8):
        text = np.append(seq.astype(np.int64), 0)
        self.n, self.sigma, self.sample = len(text), sigma, sample
        order = suffix_array(text)
        self.tree = WaveletMatrix(text[order - 1], sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        symbols = np.arange(sigma)
        self.base = self.first[:-1] - self.tree.descend(symbols, np.zeros(sigma, np.int64))
        kept = order % sample == 0
        self.marked, self.positions = Bits(kept), order[kept].astype(np.int64)
        self.order = order

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the strings that have ``symbol`` before those of [low, high)."""
        base = self.base[symbol]
        return base + self.tree.descend(symbol, low), base + self.tree.descend(symbol, high)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of patterns: row k holds pattern k in its last ``lengths[k]`` columns. Empty where it doesn't occur."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        alive = np.arange(len(patterns))
        for back in range(1, patterns.shape[1] + 1):
            alive = alive[(lengths[alive] >= back) & (low[alive] < high[alive])]
            if not len(alive):
                break
            low[alive], high[alive] = self.step(patterns[alive, -back], low[alive], high[alive])
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: step back to a sampled row, then count forward again."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while True:
            todo = todo[~self.marked.get(at[todo])]
            if not len(todo):
                break
            symbol, end = self.tree.access(at[todo])
            at[todo] = self.base[symbol] + end
            steps[todo] += 1
        return self.positions[self.marked.rank(at)] + steps
