"""Word shingles of whole texts as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from marquee.llm.textbytes import mix, prefix, slices, span_hashes

WIDTH = 5
_PLACES = np.random.default_rng(7).integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)


def words_of(ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (no ASCII white space), and how many begin before each
    text's end."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    here, before = gap[1:], gap[:-1].copy()
    before[ends[:-1]] = True  # a text begins here
    starts = np.flatnonzero(before[:-1] & ~here[:-1])
    after = here.copy()
    after[ends[1:]] = True
    stops = np.flatnonzero(~gap[1:-1] & after[1:]) + 1
    return starts, stops, np.searchsorted(starts, ends)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all other bytes as they are."""
    return np.where((data >= 0x41) & (data <= 0x5A), data + np.uint8(32), data)


def shingle_sets(ends: np.ndarray, data: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; texts with fewer words have one
    shingle of all their words, texts without words none."""
    low = lowered(data)
    starts, stops, places = words_of(ends, low)
    words = span_hashes(prefix(low), starts, stops, low) if len(starts) else np.zeros(0, np.uint64)
    n = len(words) - width + 1
    grams = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        grams += words[k : k + n] * _PLACES[k]
    grams = mix(grams)
    sets = []
    for first, last in zip(places[:-1], places[1:], strict=True):
        if last - first >= width:
            own = np.sort(grams[first : last - width + 1])
            sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif last > first:
            few = (words[first:last] * _PLACES[: last - first]).sum() + np.uint64(last - first)
            sets.append(mix(np.array([few], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_key(own: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit digests of a set."""
    a = mix(own + np.uint64(0x51ED270B)).sum(dtype=np.uint64) + np.uint64(len(own))
    b = mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def sets_of(column: pa.Array, width: int = WIDTH) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and sets of each slice of a string column without nulls."""
    for first, ends, data in slices(column):
        yield first, shingle_sets(ends, data, width)
