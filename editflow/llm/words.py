"""Words and shingles of many texts at once.

A word is a run of bytes other than space and 0x09 to 0x0D; A to Z are lower-cased,
other letters stay. `bytes.lower().split()` gives exactly these words.
"""

from __future__ import annotations

import numpy as np

WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def keys(count: int, seed: int) -> np.ndarray:
    """`count` odd 64-bit multipliers, always the same for a seed."""
    step = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(step + np.uint64(seed)) | np.uint64(1)


_PLACE = keys(1024, 1)


def _place(position: np.ndarray) -> np.ndarray:
    out = _PLACE[np.minimum(position, len(_PLACE) - 1)]
    far = position >= len(_PLACE)
    if far.any():
        out[far] = mix(position[far].astype(np.uint64) + np.uint64(7)) | np.uint64(1)
    return out


def split(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def shingle_set(text: bytes | None, k: int = 5) -> set[bytes]:
    """Distinct k-word shingles; with fewer words, all of them as one; without words, none."""
    words = split(text)
    if len(words) < k:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the number of words of each text."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(starts) - 1, np.int64)
    letter = ~_SPACE[data]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    inner = starts[:-1][starts[:-1] < len(data)]
    first[inner] = letter[inner]
    begin = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(begin, starts))
    if len(begin) == 0:
        return np.zeros(0, np.uint64), counts
    packed = _LOWER[data[letter]]
    head = np.flatnonzero(first[letter])
    length = np.diff(np.append(head, len(packed)))
    packed *= _place(np.arange(len(packed)) - np.repeat(head, length))
    return mix(np.add.reduceat(packed, head) + length.astype(np.uint64)), counts


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each k-word shingle of each text, and their number; a short text gives one."""
    ends = np.cumsum(counts)
    factor = keys(k, 2)
    many = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    if len(hashes) == 0:
        return np.zeros(0, np.uint64), many
    first = np.repeat(ends - counts - (np.cumsum(many) - many), many) + np.arange(many.sum())
    padded = np.append(hashes, np.zeros(k, np.uint64))
    total = np.zeros(len(first), np.uint64)
    left = np.repeat(ends, many) - first
    for j in range(k):
        part = padded[first + j] * factor[j]
        total += np.where(left > j, part, np.uint64(0))
    return mix(total + np.minimum(left, k).astype(np.uint64)), many
