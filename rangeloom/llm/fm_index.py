"""FM-index over a sequence of words: suffix order, wavelet-matrix ranks, sampled positions.

The text is a list of word sequences; each ends with a terminator symbol of its own, so
no match runs over the end of one. Everything works on whole numpy arrays: many phrases
are searched, and many rows located, at a time.
"""

from __future__ import annotations

import numpy as np

#: Text positions that are kept with their suffix are the multiples of this.
SAMPLE_STEP = 8

_ONE = np.uint64(1)


def suffix_order(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Start positions of all suffixes in sorted order, by prefix doubling.

    ``symbols`` are below ``2**bits`` and end with a symbol found nowhere else. Rounds
    after the first sort only suffixes that are not yet told apart.
    """
    n = len(symbols)
    depth = min(n, max(1, 62 // bits))
    key = np.zeros(n, np.int64)
    for k in range(depth):
        key <<= bits
        key[: n - k] += symbols[k:]
    order = np.argsort(key)
    sorted_key = key[order]
    head = np.empty(n, bool)
    head[0], head[1:] = True, sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(n, np.int64)
    firsts = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[order] = firsts
    while True:
        alone = head.copy()
        alone[:-1] &= head[1:]
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            return order
        at = order[open_]
        ahead = at + depth
        key = rank[at] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[open_] = at
        new = np.empty(len(key), bool)
        new[0], new[1:] = True, key[1:] != key[:-1]
        head[open_] = new
        firsts = np.maximum.accumulate(np.where(new, open_, 0))
        rank[at] = firsts
        depth *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, one packed bit vector per bit of a symbol."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.n = bits, len(values)
        self.words, self.counts, self.zeros = [], [], []
        current = values
        for level in range(bits):
            bit = ((current >> (bits - 1 - level)) & 1).astype(bool)
            packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
            some = np.packbits(bit, bitorder="little")
            packed[: len(some)] = some
            words = packed.view(np.uint64)
            counts = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=counts[1:], dtype=np.int64)
            self.words.append(words)
            self.counts.append(counts)
            self.zeros.append(self.n - int(bit.sum()))
            current = np.concatenate([current[~bit], current[bit]])
        every = np.arange(1 << bits)
        self.first = self._down(every, np.zeros(len(every), np.int64))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.counts[level][word] + np.bitwise_count(self.words[level][word] & below)

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.bits):
            ones = self._ones(level, at)
            bit = (symbols >> (self.bits - 1 - level)) & 1
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is found before position ``at``."""
        return self._down(symbols, at) - self.first[symbols]

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the positions, and how often each is found before its own."""
        symbols = np.zeros(len(at), np.int64)
        for level in range(self.bits):
            word = at >> 6
            bit = ((self.words[level][word] >> (at & 63).astype(np.uint64)) & _ONE).astype(np.int64)
            ones = self._ones(level, at)
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            symbols = (symbols << 1) | bit
        return symbols, at - self.first[symbols]


class FMIndex:
    """Index over the concatenation of ``pieces`` (arrays of 64-bit word hashes)."""

    def __init__(self, pieces: list[np.ndarray]):
        ends = np.cumsum([len(p) + 1 for p in pieces])
        self.starts = ends - np.array([len(p) + 1 for p in pieces])
        n, docs = int(ends[-1]), len(pieces)
        self.vocabulary, ids = np.unique(np.concatenate(pieces), return_inverse=True)
        symbols = np.empty(n, np.int64)
        is_end = np.zeros(n, bool)
        is_end[ends - 1] = True
        # Terminators in falling order make the last one, at the very end, the smallest symbol.
        symbols[is_end] = np.arange(docs)[::-1]
        symbols[~is_end] = ids + docs
        self.n, self.docs = n, docs
        self.bits = max(1, int(docs + len(self.vocabulary) - 1).bit_length())
        order = suffix_order(symbols, self.bits)
        self.below = np.zeros((1 << self.bits) + 1, np.int64)
        np.cumsum(np.bincount(symbols, minlength=1 << self.bits), out=self.below[1:])
        self.last = WaveletMatrix(symbols[order - 1], self.bits)
        sampled = order % SAMPLE_STEP == 0
        self.sampled, self.sample_at = sampled, np.cumsum(sampled) - 1
        self.samples = order[sampled]

    def symbols_of(self, words: np.ndarray) -> np.ndarray:
        """Symbols of word hashes, -1 for words that are not in the text."""
        if not len(self.vocabulary):
            return np.full(words.shape, -1, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + self.docs, -1)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of the suffixes that start with each phrase (a row of hashes)."""
        symbols = self.symbols_of(phrases)
        low, high = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        live = np.flatnonzero((symbols >= 0).all(axis=1))
        a, b = np.zeros(len(live), np.int64), np.full(len(live), self.n)
        for step in range(phrases.shape[1] - 1, -1, -1):
            c = symbols[live, step]
            a = self.below[c] + self.last.rank(c, a)
            b = self.below[c] + self.last.rank(c, b)
            found = a < b
            live, a, b = live[found], a[found], b[found]
        low[live], high[live] = a, b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps backward up to a sampled position."""
        places = np.empty(len(rows), np.int64)
        live, steps = np.arange(len(rows)), 0
        while len(live):
            hit = self.sampled[rows]
            places[live[hit]] = self.samples[self.sample_at[rows[hit]]] + steps
            live, rows = live[~hit], rows[~hit]
            if len(live):
                symbols, rank = self.last.access_rank(rows)
                rows, steps = self.below[symbols] + rank, steps + 1
        return places

    def occurrences(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(phrase number, text position)`` of every occurrence of every phrase."""
        low, high = self.search(phrases)
        count = high - low
        which = np.repeat(np.arange(len(phrases)), count)
        offset = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        return which, self.locate(low[which] + offset)
