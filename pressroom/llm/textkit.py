"""Hashes of words and word shingles, computed on whole arrays of bytes.

A word is a run of letters, digits, underscores or characters outside ASCII in the lower-cased
text; other ASCII characters separate words.
"""

from __future__ import annotations

import numpy as np

_TABLE = bytes(c if c >= 128 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 20
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads close values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` fixed 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64))


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 14)
        inverse = pow(_BASE, -1, 2**64)
        for name, step in (("_powers", _BASE), ("_inverse", inverse)):
            steps = np.full(size, step, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps)


def pieces_of(data: bytes):
    """A long text in parts of about a megabyte, cut before a space."""
    start = 0
    while len(data) - start > _PIECE:
        cut = data.find(b" ", start + _PIECE)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut
    yield data[start:]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, and the start and end of each word in them."""
    array = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(array) + 2, np.int8)
    inside[1:-1] = array != 32
    edges = np.flatnonzero(np.diff(inside))
    return array, edges[0::2], edges[1::2]


def folded(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass").translate(_TABLE)


def span_hashes(array: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each start to its end."""
    n = len(array)
    _grow(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((array.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _inverse[starts])


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word of the whole text, in order; memory is bounded piece by piece."""
    if not text:
        return np.empty(0, np.uint64)
    parts = [span_hashes(*word_spans(piece)) for piece in pieces_of(folded(text))]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Distinct hashes of runs of ``size`` words, ascending; a shorter text with words has one."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return words
    width = min(size, n)
    factors = seeds(size, 7) | np.uint64(1)
    total = words[: n - width + 1] * factors[0]
    for i in range(1, width):
        total = total + words[i : n - width + 1 + i] * factors[i]
    return np.unique(mix(total + np.uint64(width)))
