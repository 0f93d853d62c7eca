"""Hashes of words and word windows over whole batches of texts, vectorised with numpy.

Words are maximal runs of bytes other than the space and \\t..\\r.  A word's
hash is a polynomial of its bytes modulo 2**64, mixed; a window's hash is a
polynomial of its words' hashes, mixed.  Equal words and windows have equal
hashes everywhere; two seeds give independent hashes.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 22         # bytes hashed at a time
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)
_STEPS = (0xC2B2AE3D27D4EB4F | 1, 0xA0761D6478BD642F | 1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def blank_mask(data: bytes) -> np.ndarray:
    return _BLANK[np.frombuffer(data, np.uint8)]


def _pieces(data: bytes):
    """Parts of about PIECE bytes that no word crosses."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + PIECE)
        while end < n:
            stop = np.flatnonzero(_BLANK[np.frombuffer(data, np.uint8, min(PIECE, n - end), end)])
            if len(stop):
                end += int(stop[0])
                break
            end = min(n, end + PIECE)
        yield data[at:end]
        at = end


def word_starts(data: bytes) -> np.ndarray:
    """Byte offsets at which words start."""
    word = ~blank_mask(data)
    word[1:] &= ~word[:-1].copy()
    return np.flatnonzero(word)


def word_hashes(data: bytes, seed: int = 0) -> np.ndarray:
    """A 64-bit hash for each word of ``data``, in order."""
    out = []
    for piece in _pieces(data):
        raw = np.frombuffer(piece, np.uint8)
        word = ~_BLANK[raw]
        first = word.copy()
        first[1:] &= ~word[:-1]
        first = first[word]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        letters = raw[word].astype(np.uint64) + np.uint64(1)
        sizes = np.diff(np.append(starts, len(letters)))
        place = np.arange(len(letters)) - np.repeat(starts, sizes)
        out.append(np.add.reduceat(letters * powers(_BASES[seed], int(sizes.max()))[place], starts))
    return mix64(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def _times(a: np.uint64, b: np.uint64) -> np.uint64:
    return np.uint64(int(a) * int(b) & 0xFFFFFFFFFFFFFFFF)


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash for each run of ``size`` consecutive words; run i starts at word i.

    Runs of doubled lengths are put together by the binary digits of ``size``.
    """
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    step = np.uint64(_STEPS[seed])
    total, done, factor = np.zeros(n, np.uint64), 0, np.uint64(1)     # factor: step ** done
    run, length, jump = words, 1, step                                # jump: step ** length
    while done < size:
        if size & length:
            total += factor * run[done:done + n]
            done += length
            factor = _times(factor, jump)
        if done < size:
            run = run[:-length] + jump * run[length:]
            length, jump = 2 * length, _times(jump, jump)
    return mix64(total)
