"""Vectorised 64-bit hashes of ranges of bytes and of ranges of words.

A range's hash is ``sum(value(i) * BASE**i)`` modulo 2**64, taken from running sums, so equal ranges
have equal hashes wherever they stand.
"""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_S29, _S32 = np.uint64(29), np.uint64(32)
_VALUE = np.random.default_rng(5).integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C1B
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: ASCII white space by byte.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Longer texts are hashed in pieces that end in white space.
PIECE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S32)) * _M1
    x = (x ^ (x >> _S29)) * _M2
    return x ^ (x >> _S32)


def _powers(n: int):
    """At least ``n`` powers of the base and of its inverse."""
    if len(_POWERS[0]) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[i] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, base, np.uint64))])
    return _POWERS


def running(values: np.ndarray) -> np.ndarray:
    """Running sums for :func:`ranges`."""
    power, _ = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return total


def ranges(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the values from each start to before each end."""
    _, inverse = _powers(len(total))
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * _M1)


def byte_ranges(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return ranges(running(_VALUE[b]), start, end)


def pieces(said: bytes):
    """(offset, piece) of a text's bytes, each piece but the last ending in white space."""
    at = 0
    while at < len(said):
        end = at + PIECE_BYTES
        while end < len(said) and not SPACE[said[end - 1]]:
            end += 1
        yield at, said[at:end]
        at = end
