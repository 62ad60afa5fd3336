"""Hashed character n-grams of whole texts, in numpy, for the linear classifiers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Texts are worked through in slices of so many bytes, so that a huge one needs no more memory.
SLICE = 1 << 18
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def buckets(text: str, orders: Sequence[int], bits: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of the lower-cased text, slice by slice.

    N-grams are of UTF-8 bytes, lie within a word and may hold one blank at either end (the
    text's ends count as blanks), so that beginnings and ends of words can be told.
    """
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    longest = max(orders)
    for at in range(0, len(data), SLICE):
        piece = data[at : at + SLICE + longest - 1]
        blank = _BLANK[piece]
        wide = np.where(blank, np.uint8(32), piece).astype(np.uint64)
        found = []
        for n in orders:
            # N-grams of a shorter order that begin in the overlap belong to the next slice.
            last = min(len(piece), SLICE + n - 1) - n + 1
            if last <= 0:
                continue
            code, inner = wide[:last].copy(), np.zeros(last, bool)
            for j in range(1, n):
                code <<= np.uint64(8)
                code |= wide[j : j + last]
                if j < n - 1:
                    inner |= blank[j : j + last]
            code += np.uint64(n << 56)
            found.append(((code * _ODD) >> np.uint64(64 - bits)).astype(np.uint32)[~inner])
        yield np.concatenate(found) if found else np.empty(0, np.uint32)


class Tiers:
    """The distinct (bucket, tier) pairs of one text after another, numbered tier by tier.

    A bucket reaches tier j where the text holds it `tiers[j]` times or oftener, so a word said
    three times can weigh otherwise than one said once.
    """

    def __init__(self, orders: Sequence[int], bits: int, tiers: Sequence[int]):
        self.orders, self.bits, self.tiers = orders, bits, tiers
        self.size = len(tiers) << bits

    def of(self, text: str) -> np.ndarray:
        slices = buckets(text, self.orders, self.bits)
        found, more = next(slices), next(slices, None)
        if more is None:
            found = np.sort(found)
            starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.empty(0, int)
            where, often = found[starts], np.diff(np.r_[starts, len(found)])
        else:
            total = np.zeros(1 << self.bits, np.int64)
            for part in chain((found, more), slices):
                total += np.bincount(part, minlength=len(total))
            where = np.flatnonzero(total)
            often = total[where]
        where = where.astype(np.int32)
        return np.concatenate([where[often >= n] + (j << self.bits) for j, n in enumerate(self.tiers)])


def counts(text: str, orders: Sequence[int], bits: int) -> np.ndarray:
    """How often each bucket occurs in the text."""
    total = np.zeros(1 << bits)
    for found in buckets(text, orders, bits):
        total += np.bincount(found, minlength=1 << bits)
    return total
