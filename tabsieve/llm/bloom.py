"""A Bloom filter of 64-bit hashes, built by Spark and of bounded size.

At most ``max_bits`` bits (2 MB by default) reach the driver and the tasks, whatever the
number of keys.  It only thins rows out ahead of an exact join: beyond its
capacity more rows get through, and results stay the same.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS, BITS_PER_KEY = 1 << 10, 1 << 24, 16


class Bloom:
    """Two probes: the top bits of the hash, and of its lower half moved up."""

    def __init__(self, size: int, words: np.ndarray):
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.words = words

    def _at(self, slot: np.ndarray) -> np.ndarray:
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Indices into ``h`` (uint64) of the hashes that may be in the set."""
        first = np.flatnonzero(self._at(h >> self.shift))
        return first[self._at((h[first] << np.uint64(32)) >> self.shift) == 1]


def build(keys: DataFrame, n: int, max_bits: int = MAX_BITS) -> Bloom:
    """Filter of the long column ``h`` of ``keys``, sized for ``n`` keys."""
    size = min(max(1 << (max(n, 1) * BITS_PER_KEY - 1).bit_length(), MIN_BITS), max_bits)
    shift = 64 - (size.bit_length() - 1)
    slots = keys.select(F.explode(F.array(F.shiftrightunsigned("h", shift), F.shiftrightunsigned(
        F.shiftleft("h", 32), shift))).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, int(slot % 64)))").alias("bits"))
    out = np.zeros(size >> 6, np.int64)
    found = words.toArrow()  # at most max_bits / 64 rows of two numbers
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return Bloom(size, out.view(np.uint64))
