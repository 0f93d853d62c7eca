"""SetSketch: registers of exponentially spaced truncated minima.

Register i of a set is ``max(0, min(q + 1, floor(1 - log_b(x))))`` for the least
``x`` of exponential values that hash i gives the elements.  Sketches merge by
the larger register; equal registers are the likelier the more similar the sets.
"""

from __future__ import annotations

import numpy as np

from martlake.llm.wordhash import mix64

REGISTERS = 384
BASE, RATE, TOP = 1.001, 20.0, 65_534          # b, a and q
BAND_ROWS, BANDS = 6, 50                       # registers in a band, bands
_RNG = np.random.default_rng(20_240_601)
_FLIP = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_TIMES = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)


def sketch(elements: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Registers (sets x REGISTERS) of non-empty sets of 64-bit hashes laid end to end."""
    short = (elements >> np.uint64(32)).astype(np.uint32)
    least = np.empty((len(starts), REGISTERS), np.uint32)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat((short ^ _FLIP[i]) * _TIMES[i], starts)
    x = -np.log1p(-(least + 0.5) / 2.0 ** 32) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch; bands do not share keys."""
    part = registers[:, :BAND_ROWS * BANDS].reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
    for r in range(BAND_ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, r])
    return key.view(np.int64)


def first_shared_band(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of rows: the first band in which all registers agree; BANDS if none."""
    same = (a == b)[:, :BAND_ROWS * BANDS].reshape(-1, BANDS, BAND_ROWS).all(2)
    return np.where(same.any(1), same.argmax(1), BANDS)


def log_likelihood(j: np.ndarray, more, less, equal, size_a, size_b) -> np.ndarray:
    """Log likelihood of Jaccard similarity ``j`` given how many registers of a are larger, smaller
    and equal to b's, and the sizes of both sets."""
    u = size_a / (size_a + size_b)
    v = 1 - u
    chance = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = chance(u - v * j), chance(v - u * j)
    return more * np.log(up) + less * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))


def may_reach(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, least: float,
              margin: float = 14.0) -> np.ndarray:
    """Pairs of rows that the joint likelihood does not rule out at similarity ``least`` or more.

    A pair is ruled out if its best similarity lies below ``least`` and is ``exp(margin)`` times as
    likely as ``least``, or if the sizes alone forbid it.
    """
    more, equal = (a > b).sum(1), (a == b).sum(1)
    less = a.shape[1] - more - equal
    low, high = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    args = [x.astype(float)[:, None] for x in (more, less, equal, size_a, size_b)]
    grid = np.linspace(0, least, 33)[None, :]
    like = log_likelihood(grid, *args)
    return (low >= least * high - 1e-9) & (like.max(1) - like[:, -1] <= margin)
