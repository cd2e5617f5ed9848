"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a longest run of bytes other than space and 0x09-0x0D; A-Z are lower-cased. Hashes are
equal on every machine. Two different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False
MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
# For comparisons that ignore punctuation: ASCII letters and digits, and all bytes of other characters.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (a splitmix finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def keys(n: int, seed: int) -> np.ndarray:
    """n odd pseudo-random 64-bit numbers."""
    step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(step + np.uint64(seed)) | np.uint64(1)


def word_spans(data: np.ndarray, ends: np.ndarray, inside: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every word, and the number of words before each offset of ``ends``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
    solid = inside[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edges = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < len(data))]
    first[edges] = solid[edges]
    last[edges - 1] = solid[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(starts, ends)


def word_hashes(data: np.ndarray, ends: np.ndarray, inside: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased word in order, and the number of words before each offset."""
    starts, lengths, before = word_spans(data, ends, inside)
    if not len(starts):
        return np.zeros(0, np.uint64), before
    lower = np.concatenate([LOWER[data], np.zeros(8, np.uint8)])
    # All runs of eight bytes as numbers; a word is folded eight bytes at a time, its last ones masked.
    eights = np.ndarray((len(data),), "<u8", lower.data, strides=(1,))
    hashes = mix(lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(11))
    at, todo = starts, slice(None)
    left = lengths
    while len(at):
        piece = eights[at] & MASKS[np.minimum(left, 8)]
        hashes[todo] = mix(hashes[todo] ^ piece)
        more = np.flatnonzero(left > 8)
        todo = more if isinstance(todo, slice) else todo[more]
        at, left = at[more] + 8, left[more] - 8
    return hashes, before


def windows(hashes: np.ndarray, before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words, and the number of runs before each text.

    A text with fewer words has one run, its whole sequence; a text without words has none.
    """
    weights = keys(size, 23)
    counts = np.diff(before)
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(runs)])
    if not offsets[-1]:
        return np.zeros(0, np.uint64), offsets
    start = np.arange(offsets[-1]) - np.repeat(offsets[:-1], runs) + np.repeat(before[:-1], runs)
    left = np.repeat(before[1:], runs) - start
    total = np.zeros(offsets[-1], np.uint64)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    short = bool((left < size).any())
    for k in range(size):
        part = padded[start + k] * weights[k]
        total += np.where(left > k, part, np.uint64(0)) if short else part
    if short:  # a whole sequence must not equal a longer one that ends in zeros
        total += np.minimum(left, size).astype(np.uint64)
    else:
        total += np.uint64(size)
    return mix(total), offsets
