"""64-bit hashes of white-space separated words, for many texts at once."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 64), BASE, np.uint64))])
    return _powers


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and how many words each text has.

    Words are runs of bytes other than blank and 0x09 to 0x0D.
    """
    words = [text.split() for text in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    hashes = map(xxhash.xxh3_64_intdigest, chain.from_iterable(words))
    return np.fromiter(hashes, np.uint64, int(counts.sum())), counts


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on; places too near the end are left out."""
    places = len(words) - size + 1
    if places <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(places, np.uint64)
    for k in range(size):
        total += words[k : k + places] * (_powers_to(size + 2)[k + 1] | np.uint64(1))
    return mix(total)
