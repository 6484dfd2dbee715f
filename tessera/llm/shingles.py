"""Word shingles of texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

WORDS = 5
_MASK = (1 << 64) - 1
_rng = np.random.default_rng(7)
#: A random number per byte, so that words are hashed by random polynomials.
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.cumprod(out, out=out)
    return out


_UP, _DOWN = _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(raw: bytes) -> np.ndarray:
    """One hash per word of a text: A-Z lowered, words parted by ASCII white space."""
    global _UP, _DOWN
    data = np.frombuffer(raw, dtype=np.uint8)
    n = len(data)
    if n > len(_UP):
        size = 1 << n.bit_length()
        _UP, _DOWN = _powers(_BASE, size), _powers(_INVERSE, size)
    part = _SPACE[data]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * _UP[:n], out=sums[1:])
    edge = np.flatnonzero(np.diff(part, prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    return mix((sums[end] - sums[start]) * _DOWN[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct hashes of the 5-word shingles, ascending; of all words if there are fewer; empty without words."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    w = word_hashes(text.encode("utf-8", "replace"))
    if not len(w):
        return w
    k = min(WORDS, len(w))
    h = np.full(len(w) - k + 1, np.uint64(k))
    for i in range(k):
        h = h + w[i : len(w) - k + 1 + i] * _STEP[i]
    return np.unique(mix(h))
