"""A compressed FM-index over sequences of words, in numpy.

The Burrows-Wheeler transform is held in a wavelet matrix: a bit vector for each
bit of the symbols, packed, with a running count for each 64 bits.  Backward search
and matching statistics work on many patterns at once.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


class BitVector:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(U64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))]).astype(np.int32)
        self.zeros = len(bits) - int(bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        word = i >> 6
        mask = (U64(1) << (i & 63).astype(U64)) - U64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels: list[BitVector] = []
        self.depth = max(1, int(n_symbols - 1).bit_length())
        now = symbols
        for level in range(self.depth):
            bits = (now >> (self.depth - 1 - level)) & 1
            self.levels.append(BitVector(bits.astype(np.uint8)))
            now = np.concatenate([now[bits == 0], now[bits == 1]])
        self.begin = self._down(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits in enumerate(self.levels):
            ones = bits.ones(i)
            i = np.where((symbol >> (self.depth - 1 - level)) & 1, bits.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs among the first ``i`` symbols."""
        return self._down(symbol, i) - self.begin[symbol]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; symbol 0 ends a sequence, and each 0 counts as a symbol of its
    own, so that no comparison goes on beyond it."""
    n = len(text)
    ends = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        new = np.zeros(n, np.int64)
        ordered = rank[order]
        new[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = new
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        beyond = np.zeros(n, np.int64)
        beyond[:-width] = rank[width:] + 1
        rank = rank * (n + 1) + beyond
        order = np.argsort(rank, kind="stable")
        width *= 2


class FMIndex:
    """Index of sequences of word hashes."""

    def __init__(self, sequences: list[np.ndarray] | None = None, *, words: np.ndarray | None = None, lengths: np.ndarray | None = None):
        if sequences is not None:
            lengths = np.array([len(s) for s in sequences], np.int64)
            words = np.concatenate(sequences) if sequences else np.zeros(0, U64)
        self.lengths = np.asarray(lengths, np.int64)
        self.alphabet, coded = np.unique(words, return_inverse=True)
        self.start = np.cumsum(self.lengths + 1) - (self.lengths + 1)  # places in the text with its end marks
        text = np.zeros(int((self.lengths + 1).sum()), np.int64)
        inside = np.ones(len(text), bool)
        inside[self.start + self.lengths] = False
        text[inside] = coded.reshape(-1) + 1
        self.text = text
        self.n_symbols = len(self.alphabet) + 1
        before = suffix_array(text) - 1  # the place before each suffix
        self.last = WaveletMatrix(text[before], self.n_symbols)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.n_symbols))])

    def code(self, words: np.ndarray) -> np.ndarray:
        """Symbols of word hashes, -1 for words that the index lacks."""
        if not len(self.alphabet):
            return np.full(len(words), -1)
        i = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        return np.where(self.alphabet[i] == words, i + 1, -1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: intervals of the suffixes that begin with each symbol
        followed by what [low, high) begin with."""
        both = self.last.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.smaller[symbol] + both[:len(symbol)], self.smaller[symbol] + both[len(symbol):]

    def matching_statistics(self, stream: np.ndarray, ends: np.ndarray, limit: int, others: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """For each end in a stream of symbols (0 and -1 break it), how many symbols up to
        there, ``limit`` at most, occur at least ``others`` times in the index, and the first
        suffix of the interval at ``limit`` (-1 below)."""
        length, at = np.zeros(len(ends), np.int64), np.full(len(ends), -1)
        live, low, high = np.arange(len(ends)), np.zeros(len(ends), np.int64), np.full(len(ends), len(self.text))
        for step in range(limit):
            place = ends[live] - 1 - step
            symbol = np.where(place >= 0, stream[np.maximum(place, 0)], -1)
            ok = symbol > 0
            live, low, high, symbol = live[ok], low[ok], high[ok], symbol[ok]
            low, high = self.extend(symbol, low, high)
            ok = high - low >= others
            live, low, high = live[ok], low[ok], high[ok]
            length[live] = step + 1
            if not len(live):
                break
        full = length[live] == limit
        at[live[full]] = low[full]
        return length, at
