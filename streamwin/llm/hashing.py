"""64-bit hashes of words and of windows of words, for whole texts at a time."""

from __future__ import annotations

import numpy as np
import xxhash

_GOLDEN = 0x9E3779B97F4A7C15


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def multipliers(count: int, seed: int) -> np.ndarray:
    """Odd numbers, one for each place in a window."""
    places = np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 20)
    return mixed(places * np.uint64(_GOLDEN)) | np.uint64(1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A hash of each run of ``len(factors)`` neighbouring words."""
    count = max(0, len(words) - len(factors) + 1)
    total = np.zeros(count, np.uint64)
    for place, factor in enumerate(factors):
        total += words[place : place + count] * factor
    return mixed(total)
