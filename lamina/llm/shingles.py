"""Word shingles of whole texts as 64-bit hashes, computed in numpy over batches."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORDS = 5

_WORD = re.compile(r"\w+")

# Odd multipliers of the mixing function.
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_S1, _S2, _S3 = np.uint64(30), np.uint64(27), np.uint64(31)


def mixed(values: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of 64-bit values."""
    x = values + _M1
    x = (x ^ (x >> _S1)) * _M2
    x = (x ^ (x >> _S2)) * _M3
    return x ^ (x >> _S3)


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores in lower case."""
    return _WORD.findall(text.lower()) if text else []


def word_hashes(words: list[str]) -> np.ndarray:
    """A hash a word. To hash a word again takes less time than to look it up, and no memory."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, size: int = WORDS) -> np.ndarray:
    """A hash a run of `size` words; fewer words than that are one shingle, none are none."""
    if len(hashes) == 0:
        return hashes
    n = max(1, len(hashes) - size + 1)
    found = np.zeros(n, np.uint64)
    for i in range(min(size, len(hashes))):
        found = mixed(found * _M1 + hashes[i : i + n])
    return found


def counted(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles in order, and how often each occurs."""
    return np.unique(shingles, return_counts=True)


def generalised_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum of the smaller weights over the sum of the larger ones, of sorted distinct keys."""
    total = int(wa.sum()) + int(wb.sum())
    if total == 0:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = int(np.minimum(wa[i], wb[j]).sum())
    return common / (total - common)
