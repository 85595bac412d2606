"""Byte-level text helpers used inside tasks.

A word is a run of bytes other than space and 0x09-0x0D, which is what
``bytes.split()`` yields; lower-casing touches A-Z only.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)          # odd, so it has an inverse modulo 2^64
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)


class _Powers:
    """Powers of the base and of its inverse, grown to the longest text seen."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up = np.cumprod(np.concatenate(([_U(1)], np.full(size - 1, _BASE))))
            self.down = np.cumprod(np.concatenate(([_U(1)], np.full(size - 1, _BASE_INV))))
        return self.up, self.down


_POWERS = _Powers()


class RollingHash:
    """64-bit hashes of any substrings of ``data``: two gathers and a product
    each, after one pass over the bytes."""

    def __init__(self, data: bytes) -> None:
        a = np.frombuffer(data, dtype=np.uint8)
        up, self._down = _POWERS.upto(len(a) + 1)
        self._prefix = np.zeros(len(a) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[a] * up[:len(a)], out=self._prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        p = self._prefix
        return mix64((p[end] - p[start]) * self._down[start])


def joined_words(data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by single spaces, and the start and end of each."""
    words = data.split()
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    return b" ".join(words), ends - lengths, ends


def shingle_bounds(starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the ``size``-word shingles; a shorter, non-empty sequence of
    words is one shingle."""
    if len(starts) == 0:
        return starts, ends
    if len(starts) <= size:
        return starts[:1], ends[-1:]
    return starts[:len(starts) - size + 1], ends[size - 1:]


def as_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""
