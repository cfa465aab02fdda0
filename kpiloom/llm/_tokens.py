"""Token hashes of many texts at once.

A token is a maximal run of ASCII letters, digits and non-ASCII characters of
the lower-cased text; everything else separates.  Its hash is a polynomial of
its UTF-8 bytes modulo 2**64, mixed with its length, so numpy can take all
hashes of a buffer from one running sum.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 19
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True

_powers = {b: np.ones(1, dtype=np.uint64) for b in (_BASE, _INVERSE)}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    if len(_powers[base]) < n:
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pieces(words: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about _PIECE bytes that split no token."""
    at, n = 0, len(words)
    while at < n:
        end = min(n, at + _PIECE)
        while end < n and words[end]:
            gaps = np.flatnonzero(~words[end : end + _PIECE])
            end = end + int(gaps[0]) if len(gaps) else min(n, end + _PIECE)
        yield at, end
        at = end


def token_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all texts' tokens in order, offsets: text i has [offsets[i]:offsets[i+1]])."""
    encoded = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    buffer = np.frombuffer(b"\n".join(encoded) + b"\n", dtype=np.uint8)
    ends_of_texts = np.cumsum([len(e) + 1 for e in encoded])
    words = _WORD[buffer]
    hashes, starts = [], []
    for a, b in _pieces(words):
        inside = words[a:b].astype(np.int8)
        edge = np.diff(inside, prepend=np.int8(0), append=np.int8(0))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(s):
            continue
        terms = (buffer[a:b].astype(np.uint64) + np.uint64(1)) * _power(_BASE, b - a)
        sums = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum(terms, out=sums[1:])
        h = (sums[e] - sums[s]) * _power(_INVERSE, b - a)[s]
        hashes.append(mixed(h + (e - s).astype(np.uint64)))
        starts.append(s + a)
    if not hashes:
        none = np.zeros(0, dtype=np.uint64)
        return none, np.zeros(len(texts) + 1, dtype=np.int64)
    offsets = np.searchsorted(np.concatenate(starts), np.concatenate([[0], ends_of_texts]))
    return np.concatenate(hashes), offsets


def slices(texts: Sequence[str], chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``chars`` characters, one text at least."""
    at = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
