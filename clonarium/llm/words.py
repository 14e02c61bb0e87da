"""Words of a text as numbers, and exact names for windows of words."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_BASE = 0x9E3779B97F4A7C15


def words_of(text: str) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8: bytes split on just these six characters."""
    return text.encode("utf-8", "surrogatepass").split()


def numbered(words: Sequence[bytes]) -> np.ndarray:
    """A number per word, the same for equal words only."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def may_repeat(ids: np.ndarray, width: int) -> bool:
    """False only if no window of ``width`` words, a power of two, occurs twice. Takes one sort."""
    sums = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE)
    sums ^= sums >> np.uint64(29)
    size = 1
    while size < width:
        if len(sums) <= size:
            return False
        sums = sums[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + sums[size:]
        size *= 2
    sums = np.sort(sums)
    return bool((sums[1:] == sums[:-1]).any())


def doubled(names: np.ndarray, size: int) -> np.ndarray:
    """Names of windows of ``2 * size`` words from those of ``size`` words; equal for equal windows only."""
    pairs = names[:-size] * (int(names.max()) + 1) + names[size:]
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


def window_names(ids: np.ndarray, width: int) -> np.ndarray:
    """A number for each window of ``width`` words, a power of two, the same for equal windows only."""
    size = 1
    while size < width:
        ids, size = doubled(ids, size), 2 * size
    return ids
