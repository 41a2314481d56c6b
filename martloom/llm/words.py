"""Words of a text as 64-bit hashes, and hashes of runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers of the places in a run, and of the last mixing (splitmix64).
_PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
     0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    np.uint64,
)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers in which every bit depends on all others."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hash by word (bytes), kept for words met before; emptied once ``most`` bytes are held."""

    def __init__(self, most: int = 60_000_000):
        super().__init__()
        self.most, self.held = most, 0

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 96:
            self.held += len(word) + 180
            if self.held > self.most:
                self.clear()
                self.held = len(word) + 180
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words; different lengths have different hashes."""
    n = len(hashes) - length + 1
    total = np.full(max(0, n), length, np.uint64)
    for k in range(length):
        total += hashes[k : k + n] * _PLACES[k]
    return mixed(total)
