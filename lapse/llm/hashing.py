"""Vectorised hashing of word sequences."""

from __future__ import annotations

import numpy as np
import xxhash


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def phrase_hash(words: np.ndarray, n: int, salt: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes."""
    size = len(words) - n + 1
    out = np.zeros(max(0, size), np.uint64)
    if size > 0:
        odd = mix(np.arange(n, dtype=np.uint64) + np.uint64(1000 * salt + 1)) | np.uint64(1)
        for j in range(n):
            out += words[j:j + size] * odd[j]
    return mix(out)
