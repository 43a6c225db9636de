"""Hashed character n-grams of many words at once."""

from __future__ import annotations

import numpy as np

_PRIME, _SPREAD = np.uint32(16777619), np.uint32(2654435761)


def _finish(h: np.ndarray, buckets: int) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * _SPREAD
    return ((h ^ (h >> np.uint32(13))) % np.uint32(buckets)).astype(np.int64)


def hashed_ngrams(words: list[str], sizes: tuple[int, ...], buckets: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every n-gram of the words, each between marks for its ends, and with
    ``whole`` of every word itself; in the order of the words."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    number = np.repeat(np.arange(len(words)), lengths)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(codes)) - starts[number]
    left = lengths[number] - place  # characters of the word from here on
    owners, found = [], []
    for n in sizes:
        first = np.flatnonzero(left >= n)
        h = np.full(len(first), n, dtype=np.uint32)
        for j in range(n):
            h = (h ^ codes[first + j]) * _PRIME
        owners.append(number[first])
        found.append(_finish(h, buckets))
    if whole and len(words):
        mixed = ((codes ^ (place.astype(np.uint32) * _SPREAD)) * _PRIME) ^ (codes << np.uint32(7))
        owners.append(np.arange(len(words)))
        found.append(_finish(np.add.reduceat(mixed * _SPREAD, starts, dtype=np.uint32), buckets))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    owner, bucket = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    return owner[order], bucket[order]
