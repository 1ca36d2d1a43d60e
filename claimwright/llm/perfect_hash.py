"""A minimal perfect hash over 64-bit keys, built and asked with whole arrays.

Keys are thrown into a bit array; those that land alone set their bit, the others go on to
a further, smaller array under another hash. The slot of a key is the number of set bits
before its own, so ``n`` keys fill the slots ``0..n-1``. A lookup probes less than two
arrays on average, whatever ``n`` is. Keys that were never put in are told apart by stored
fingerprints.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Bits of an array for every key thrown into it.
GAMMA = 2
MAX_LEVELS = 48


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A well-mixed 64-bit hash of integer keys."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 101) >> np.uint64(32)).astype(np.uint32)


@dataclass
class PerfectHash:
    """``words`` holds the bit arrays of all levels, ``sizes`` their lengths in words."""

    words: np.ndarray
    sizes: np.ndarray

    def __post_init__(self) -> None:
        self._starts = np.r_[0, np.cumsum(self.sizes)].astype(np.int64)
        self._before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """From distinct keys."""
        left, levels = keys.astype(np.uint64), []
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise ValueError("keys are not distinct")
            n_words = max(1, -(-GAMMA * len(left) // 64))
            places = mixed(left, len(levels)) % np.uint64(64 * n_words)
            hits = np.bincount(places.astype(np.int64), minlength=64 * n_words)
            alone = hits == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[places.astype(np.int64)]]
        sizes = np.array([len(level) for level in levels], dtype=np.int64)
        return cls(np.concatenate([*levels, np.empty(0, "<u8")]), sizes)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key; -1, or a slot of another key, for one never put in."""
        keys = keys.astype(np.uint64)
        found = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            places = mixed(keys[left], level) % np.uint64(64 * int(size))
            word = self._starts[level] + (places >> np.uint64(6)).astype(np.int64)
            bit = places & np.uint64(63)
            is_set = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            at = self._before[word] + np.bitwise_count(below)
            found[left[is_set]] = at[is_set]
            left = left[~is_set]
            if not len(left):
                break
        return found
