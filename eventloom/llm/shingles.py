"""Word hashes and shingle sets of whole texts, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

from eventloom.llm.common import LOWER, UPPER

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_P = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
_INV = pow(_P, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grow(n: int) -> None:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((_P, _INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word between ASCII white space, A-Z in lower case, in order."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    flat = np.frombuffer(b" ".join(words), np.uint8)
    _grow(len(flat) + 1)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _powers[0][: len(flat)], out=sums[1:])
    size = np.fromiter(map(len, words), np.int64, len(words))
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    return mix((sums[stop] - sums[start]) * _powers[1][start] + size.astype(np.uint64))


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of `width` words, in order."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(out)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct shingles; a text of fewer words, but not none, is one shingle."""
    words = word_hashes(text)
    if 0 < len(words) < width:
        return mix(grams(words, len(words)) + np.uint64(len(words)))
    return np.unique(grams(words, width))


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit id of a shingle set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)
