"""Vectorised hashes of words and shingles of UTF-8 texts."""

from __future__ import annotations

import functools

import numpy as np

#: Hash functions of a signature, and more of a sketch.
SYMBOLS = 32
SKETCH = 128

_U = np.uint64
_POWER, _ODD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@functools.lru_cache(maxsize=1)
def constants() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Random values of bytes, space flags of bytes, shingle multipliers and hash multipliers of signature and sketch (all odd)."""
    rng = np.random.Generator(np.random.PCG64(20240229))
    odd = lambda n: rng.integers(0, 2**63, n, dtype=_U) * _U(2) + _U(1)
    space = np.zeros(256, dtype=bool)
    space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return odd(256), space, odd(64), np.concatenate((odd(SYMBOLS), odd(SKETCH)))


_powers: list[np.ndarray] = [np.ones(1, dtype=_U), np.ones(1, dtype=_U)]


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_POWER, pow(_POWER, -1, 1 << 64))):
            factors = np.full(1 << (n - 1).bit_length(), base, dtype=_U)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(_ODD)
    x = (x ^ (x >> _U(32))) * _U(_ODD)
    return x ^ (x >> _U(32))


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of other bytes than the six ASCII spaces."""
    blank = np.concatenate(([True], constants()[1][raw], [True]))
    borders = np.flatnonzero(blank[1:] != blank[:-1])
    return borders[0::2], borders[1::2]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings raw[start:end]."""
    up, down = _powers_to(len(raw) + 1)
    sums = np.concatenate((np.zeros(1, dtype=_U), np.cumsum(constants()[0][raw] * up[: len(raw)], dtype=_U)))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def shingles_of(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the runs of ``words`` words, in order; of all words if they are fewer."""
    size = min(len(hashes), words)
    out = np.full(len(hashes) - size + 1, size, dtype=_U)
    for k in range(size):
        out += hashes[k: len(hashes) - size + 1 + k] * constants()[2][k]
    return mix(out)
