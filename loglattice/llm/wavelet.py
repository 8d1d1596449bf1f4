"""A wavelet matrix over a sequence of small class numbers, with rank queries for many positions at once."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with the number of ones before every 64th position."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, upto: np.ndarray) -> np.ndarray:
        """Ones among the first `upto` bits."""
        word = upto >> 6
        mask = (np.uint64(1) << (upto & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """One bit vector for each bit of the classes, highest first; zeros go before ones at every level."""

    def __init__(self, classes: np.ndarray, n_bits: int):
        self.length, self.levels = len(classes), []
        for bit in range(n_bits - 1, -1, -1):
            one = (classes >> bit) & 1 == 1
            zero_count = self.length - int(one.sum())
            self.levels.append((bit, BitVector(one), zero_count))
            classes = np.concatenate([classes[~one], classes[one]])

    def rank(self, wanted: int, upto: np.ndarray) -> np.ndarray:
        """How often a class occurs among the first `upto` places."""
        low, high = np.zeros(1, np.int64), np.asarray(upto, np.int64)
        for bit, vector, zero_count in self.levels:
            ones_low, ones_high = vector.ones(low), vector.ones(high)
            if wanted >> bit & 1:
                low, high = zero_count + ones_low, zero_count + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return high - low
