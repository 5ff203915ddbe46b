"""Vectorised word and shingle hashes over UTF-8 buffers.

Words are runs of bytes other than space, tab, LF, VT, FF and CR. A word's hash is a 64-bit
polynomial of its bytes, finished by a mixing step; hashes of consecutive words combine into
shingle hashes. Everything works on whole buffers, so there is no Python step per word.
"""

from __future__ import annotations

import numpy as np

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SEGMENT = 1 << 19
_powers = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """The finishing step of a 64-bit hash; one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 256)
        _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _BASE, np.uint64))])
    return _powers


def _segments(space: np.ndarray):
    """Cut points at white space, so that a segment holds whole words and about _SEGMENT bytes."""
    n, start = len(space), 0
    while start < n:
        end = min(n, start + _SEGMENT)
        while end < n and not space[end]:
            more = np.flatnonzero(space[end : end + _SEGMENT])
            end = end + int(more[0]) if len(more) else min(n, end + _SEGMENT)
        yield start, end
        start = end


def word_hashes(buf: np.ndarray, lower: bool = False, is_space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of each word of ``buf`` (uint8); ``is_space`` tells which bytes part words."""
    starts_all, hashes_all = [], []
    space_all = is_space[buf]
    for a, b in _segments(space_all):
        part, space = buf[a:b], space_all[a:b]
        first = ~space
        first[1:] &= space[:-1]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        index = np.arange(len(part), dtype=np.int32)
        at = np.zeros(len(part), np.int32)
        at[starts] = starts
        np.maximum.accumulate(at, out=at)
        place = index - at
        value = (LOWER[part] if lower else part).astype(np.uint64)
        value += np.uint64(1)
        value[space] = 0
        value *= _power(int(place.max()) + 1)[place]
        hashes_all.append(mix(np.add.reduceat(value, starts)))
        starts_all.append(starts.astype(np.int64) + a)
    if not starts_all:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts_all), np.concatenate(hashes_all)


def joined(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all items with a space after each, and each item's start, then the end."""
    buf = np.frombuffer(b" ".join([*items, b""]), np.uint8)
    lengths = np.fromiter((len(x) + 1 for x in items), np.int64, len(items))
    return buf, np.concatenate([[0], np.cumsum(lengths)])


def doc_words(items: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all items in order, and for each item the range of its words."""
    buf, offsets = joined(items)
    starts, hashes = word_hashes(buf, lower)
    return hashes, np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place on; the last k-1 places have none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + n])
    return out


def doc_shingles(items: list[bytes], k: int, lower: bool = True) -> list[np.ndarray]:
    """Each item's sorted distinct k-word shingle hashes.

    With fewer than k words, the whole sequence is the one shingle; without words there is none.
    """
    hashes, bounds = doc_words(items, lower)
    full = windows(hashes, k)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        n = b - a
        if n >= k:
            out.append(np.unique(full[a : b - k + 1]))
        elif n:
            out.append(windows(hashes[a:b], int(n)) ^ np.uint64(n))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
