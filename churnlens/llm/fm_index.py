"""FM-index over a sequence of symbols: wavelet matrix of its Burrows-Wheeler transform, backward search in numpy.

All searches of a call advance together, one symbol a step, so a step costs a
few array operations per level of the matrix.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` symbols (at least), by prefix doubling."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    done = 1
    key = text.astype(np.int64)
    while True:
        sorted_key = key[order]
        rank[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
        if done >= depth or rank[order[-1]] == n - 1:
            return order
        following = np.zeros(n, np.int64)
        following[:n - done] = rank[done:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        done *= 2


class WaveletMatrix:
    """Rank of a symbol up to a place, over bit vectors packed to words with a running count for each word."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.levels = []
        n = len(symbols)
        for b in range(self.bits - 1, -1, -1):
            bit = (symbols >> b & 1).astype(np.uint8)
            packed = np.packbits(np.concatenate([bit, np.zeros(64 - n % 64, np.uint8)]), bitorder="little").view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])[:-1].astype(np.int32)
            self.levels.append((b, packed, before, n - int(bit.sum())))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def walk(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the rank of ``symbol`` before ``place`` ends up in the last level (less walk(symbol, 0): the rank)."""
        for b, packed, before, zeros in self.levels:
            word = place >> 6
            low = packed[word] & ((np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1))
            ones = before[word] + np.bitwise_count(low)
            place = np.where(symbol >> b & 1, zeros + ones, place - ones)
        return place


class FmIndex:
    """Index of ``text`` (symbols 0..alphabet-1) for patterns of up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, alphabet: int, depth: int):
        self.n = len(text)
        self.suffixes = suffix_order(text, depth)
        self.matrix = WaveletMatrix(text[self.suffixes - 1], alphabet)
        below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])[:-1]
        every = np.arange(alphabet)
        self.base = below - self.matrix.walk(every, np.zeros(alphabet, np.int64))

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: from the suffixes that begin with P to those that begin with symbol P."""
        both = self.base[symbol]
        k = len(symbol)
        ends = self.matrix.walk(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return both + ends[:k], both + ends[k:]

    def repeats(self, text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matches of the pieces text[s:s+length] that occur more than once: (number of the piece, low, high).

        The pieces are streamed backwards; one whose interval has shrunk to a
        single suffix has a matching statistic below ``length`` everywhere
        else and is left out from there on.
        """
        piece = np.arange(len(starts))
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        for k in range(length - 1, -1, -1):
            low, high = self.extend(text[starts[piece] + k], low, high)
            more = high - low > 1
            if not more.all():
                piece, low, high = piece[more], low[more], high[more]
            if not len(piece):
                break
        return piece, low, high

    def first_places(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest text place in each interval of suffixes; equal or disjoint intervals."""
        every, inverse = np.unique(low, return_index=False, return_inverse=True)
        ends = np.zeros(len(every), np.int64)
        ends[inverse] = high
        cuts = np.stack([every, ends], axis=1).ravel()
        least = np.minimum.reduceat(np.append(self.suffixes, self.n), cuts)[::2] if len(cuts) else every
        return least[inverse]
