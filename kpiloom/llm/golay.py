"""The binary Golay code [23, 12, 7] as a fuzzy hash of 23-bit words.

The code is perfect: every word lies within 3 bits of exactly one codeword.  A
word's keys are the codeword indices (12 bits) of the words within one bit of
it, one or six of them.  Two words that differ in at most 2 bits have a word
within one bit of both, so they share a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
GENERATOR = 0b101011100011


def _remainder(words: np.ndarray) -> np.ndarray:
    """Words modulo the generator polynomial."""
    r = words.copy()
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        r = np.where(r >> bit & 1 == 1, r ^ (GENERATOR << (bit - CHECKS)), r)
    return r


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits, and the error of each syndrome."""
    low, high = _remainder(np.arange(1 << 12)), _remainder(np.arange(1 << 11) << 12)
    errors = np.array([sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(LENGTH), n)])
    by_syndrome = np.zeros(1 << CHECKS, dtype=np.int64)
    by_syndrome[_remainder(errors)] = errors
    return low, high, by_syndrome


_LOW, _HIGH, _ERROR = _tables()


def nearest(words: np.ndarray) -> np.ndarray:
    """Index of the codeword within 3 bits of each word."""
    words = words.astype(np.int64)
    return (words ^ _ERROR[_LOW[words & 0xFFF] ^ _HIGH[words >> 12]]) >> CHECKS


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, key) of every distinct key of each word."""
    flips = np.concatenate([[0], 1 << np.arange(LENGTH)])
    found = np.sort(nearest(words.astype(np.int64)[:, None] ^ flips), axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(new)[0], found[new]
