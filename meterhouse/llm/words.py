"""Word hashes inside tasks: ASCII white space separates words, everything else belongs to them."""

from __future__ import annotations

import numpy as np
import xxhash

FACTOR = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of each word met so far; forgets when it holds too many."""

    LIMIT = 1_000_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def scrambled(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of each value; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(ids: np.ndarray, width: int, factor: np.uint64 = FACTOR) -> np.ndarray:
    """Hash of each run of ``width`` ids, by doubling; empty if there are fewer ids."""
    if len(ids) < width:
        return np.zeros(0, np.uint64)
    total, taken, power, step = None, 0, ids, 1
    while True:
        if width & step:
            if total is None:
                total = power
            else:
                more = power[taken:]
                size = min(len(total), len(more))
                total = scrambled(total[:size] * factor + more[:size])
            taken += step
        if step * 2 > width:
            return total[: len(ids) - width + 1]
        power = scrambled(power[: len(power) - step] * factor + power[step:])
        step *= 2
