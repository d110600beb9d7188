"""Words, shingles and their 64-bit hashes for many documents at once, on byte arrays.

Everything here works on the UTF-8 bytes of a run of documents. Words are runs of bytes that a
256-entry table maps to a nonzero class; hashes are computed for all words of a block together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Separators of the word rule: space and the control characters 0x09 to 0x0D.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
BLOCK = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective mixing of 64-bit values (the splitmix64 finalizer), on a copy."""
    z = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


#: A random-looking 64-bit value for each byte.
BYTE_VALUES = mix(np.arange(256, dtype=np.uint64), 11)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    forward = np.empty(n, np.uint64)
    backward = np.empty(n, np.uint64)
    forward[0] = backward[0] = 1
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        f = np.uint64(pow(_BASE, filled, 1 << 64))
        b = np.uint64(pow(inverse, filled, 1 << 64))
        forward[filled:filled + step] = forward[:step] * f
        backward[filled:filled + step] = backward[:step] * b
        filled += step
    return forward, backward


_TABLES = [_powers(2)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES[0][0]) < n:
        _TABLES[0] = _powers(n)
    return _TABLES[0]


def space_table(fold: bool) -> np.ndarray:
    """Byte classes for words between white space; ``fold`` lower-cases A-Z."""
    out = np.arange(256, dtype=np.uint8)
    out[0] = 1  # a NUL byte is part of a word
    if fold:
        out[65:91] += 32
    out[list(SPACES)] = 0
    return out


def letter_table() -> np.ndarray:
    """Byte classes for words of letters: a-z, A-Z folded, and all bytes beyond ASCII."""
    out = np.zeros(256, np.uint8)
    out[97:123] = np.arange(97, 123)
    out[65:91] = np.arange(97, 123)
    out[128:] = np.arange(128, 256)
    return out


@dataclass
class Words:
    """Words of a run of documents: byte positions, hashes, and where each document's begin."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # document d has the words first[d] : first[d + 1]

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _cut(classes: np.ndarray, offsets: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where no word is cut."""
    n = len(classes)
    while at < n:
        stop = min(n, at + 4096)
        gap = np.flatnonzero(classes[at:stop] == 0)
        place = at + int(gap[0]) if len(gap) else stop
        i = int(np.searchsorted(offsets, at))
        if i < len(offsets) and offsets[i] <= place:
            return int(offsets[i])
        if len(gap):
            return place
        at = stop
    return n


def scan(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """All words of the documents ``data[offsets[d] : offsets[d + 1]]``."""
    n = len(data)
    starts, ends, hashes = [], [], []
    classes = table[data]
    at = 0
    while at < n:
        stop = n if at + BLOCK >= n else _cut(classes, offsets, at + BLOCK)
        part = classes[at:stop]
        inside = part != 0
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        lo, hi = np.searchsorted(offsets, [at, stop])
        edges = offsets[lo:hi] - at
        edges = edges[edges < len(part)]
        opens[edges] = inside[edges]
        before = edges[edges > 0] - 1
        closes[before] = inside[before]
        s, e = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[part] * up[:len(part)], out=sums[1:])
        value = (sums[e] - sums[s]) * down[s]
        hashes.append(mix(value + (e - s).astype(np.uint64)))
        starts.append(s + at)
        ends.append(e + at)
        at = stop
    if not starts:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    start = np.concatenate(starts)
    first = np.searchsorted(start, offsets, side="left")
    return Words(start, np.concatenate(ends), np.concatenate(hashes), first)


_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; empty when there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    value = words[:n].copy()
    for j in range(1, size):
        value *= _STEP
        value += words[j:j + n]
    return mix(value, 100 + size)


def sequence_hash(words: np.ndarray) -> np.ndarray:
    """One hash for a whole sequence shorter than a shingle."""
    return shingle_hashes(words, len(words))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles; fewer words make one shingle of all, none make the empty set."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(shingle_hashes(words, min(size, len(words))))


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte position: entry i counts those that begin before byte i."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
