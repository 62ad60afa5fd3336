"""Hashed word shingles of whole texts, in numpy."""

from __future__ import annotations

import numpy as np

_C = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Texts are cut at a blank into slices of about so many bytes, so that memory stays bounded.
SLICE = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), 0x9E3779B97F4A7C15, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def _hash_words(data: np.ndarray) -> np.ndarray:
    full = ~_BLANK[data]
    begins = full.copy()
    begins[1:] &= ~full[:-1]
    starts = np.flatnonzero(begins)
    if len(starts) == 0:
        return np.empty(0, np.uint64)
    at = np.flatnonzero(full)
    first = np.searchsorted(at, starts)
    lengths = np.diff(np.r_[first, len(at)])
    place = np.arange(len(at)) - np.repeat(first, lengths)
    values = (data[at].astype(np.uint64) + np.uint64(1)) * _power_table(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * _C[1])


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of the text, A-Z lower-cased, in order."""
    data = np.frombuffer((text or "").encode("utf-8", "replace").lower(), np.uint8)
    if len(data) <= SLICE:
        return _hash_words(data)
    found, at = [], 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data) and not _BLANK[data[end]]:
            nearest = np.flatnonzero(_BLANK[data[end : end + SLICE]])
            end = end + int(nearest[0]) if len(nearest) else min(end + SLICE, len(data))
        found.append(_hash_words(data[at:end]))
        at = end
    return np.concatenate(found)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of so many words; of a shorter text, of its one run."""
    hashes = word_hashes(text)
    if len(hashes) == 0:
        return hashes
    size = min(words, len(hashes))
    last = len(hashes) - size + 1
    total = np.full(last, size, np.uint64) * _C[0]
    for j in range(size):
        total = mix(total ^ (hashes[j : j + last] * _C[j % len(_C)]))
    return np.unique(total)
