"""Word hashes and hashes of word windows, as numpy arrays, for code that runs inside tasks."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

BASE = np.uint64(0x9E3779B97F4A7C15)
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split(text: str | None, lower: bool = False) -> list[bytes]:
    """Runs of anything but space and U+0009 to U+000D; A-Z in lower case on request."""
    if not isinstance(text, str):
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every `size` consecutive words; a polynomial built by doubling, then mixed."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, done, part, length = None, 0, words, 1
    while True:
        if size & length:
            shift = np.uint64(pow(int(BASE), length, 1 << 64))
            total = part[:n].copy() if total is None else total * shift + part[done : done + n]
            done += length
        if length * 2 > size:
            return mix(total + np.uint64(size))
        shift = np.uint64(pow(int(BASE), length, 1 << 64))
        part = part[: len(part) - length] * shift + part[length:]
        length *= 2


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct window hashes in ascending order; a shorter text is one shingle, none has none."""
    if not len(words):
        return words
    return np.unique(windows(words, min(size, len(words))))
