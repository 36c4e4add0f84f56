"""Hashed character n-grams of whole texts, in numpy (used inside tasks)."""

from __future__ import annotations

from functools import cache

import numpy as np

# Characters hashed at a time: bounds the memory that a long text takes.
CHUNK = 1 << 20

MIX = np.uint64(0x9E3779B97F4A7C15)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@cache
def letter_table() -> np.ndarray:
    """True at the code points of letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def only_letters(text: str) -> np.ndarray:
    """Lower-case letters, each stretch of anything else as one blank, a blank at both ends."""
    own = codes(text.lower())
    own = np.where(letter_table()[own], own, np.uint32(32))
    own = np.concatenate([[32], own, [32]]).astype(np.uint32)
    keep = np.ones(len(own), bool)
    keep[1:] = (own[1:] != 32) | (own[:-1] != 32)
    return own[keep]


def count_grams(chars: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Counts of the n-grams of the given sizes in 2 ** bits hashed places."""
    counts = np.zeros(1 << bits, np.int64)
    reach = max(sizes) - 1
    for at in range(0, len(chars), CHUNK):
        part = chars[at : at + CHUNK + reach].astype(np.uint64)
        for n in sizes:
            # A gram belongs to the chunk that it begins in.
            m = min(len(part) - n + 1, CHUNK)
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = (h ^ part[k : k + m]) * MIX
                h ^= h >> np.uint64(29)
            places = (h * MIX) >> np.uint64(64 - bits)
            counts += np.bincount(places.astype(np.int64), minlength=1 << bits)
    return counts
