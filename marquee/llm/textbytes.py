"""Texts of an Arrow batch as one byte array, and hashes of spans of it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LONG = 128  # bytes of a span that a polynomial tells apart
SLICE = 2 << 20  # bytes of text worked on at once; a longer text is a slice of its own

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.default_rng(20260101).integers(0, 1 << 64, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, first is where the first text begins) and bytes of a string column
    without nulls."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    return ends.astype(np.int64), np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of whole texts of about ``limit`` bytes: first row, offsets from 0, bytes."""
    ends, data = column_bytes(column)
    first, rows = 0, len(ends) - 1
    while first < rows:
        last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, ends[first : last + 1] - ends[first], data[ends[first] : ends[last]]
        first = last


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(n + n // 4, base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any span follows."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * _powers(_BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the bytes between ``starts`` and ``ends``.

    They are polynomials modulo a power of two, under which some regular strings of many
    hundred bytes are equal, whatever the base. Given ``data``, spans of more than ``LONG``
    bytes, which are few among words and pieces, get a cryptographic hash instead.
    """
    back = _powers(_INVERSE, len(sums))
    hashes = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    if data is not None:
        for i in np.flatnonzero(ends - starts > LONG).tolist():
            content = np.ascontiguousarray(data[starts[i] : ends[i]])
            hashes[i] = int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little")
    return hashes


def window_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all spans of ``width`` bytes, by start."""
    n = max(len(sums) - width, 0)
    return mix((sums[width:] - sums[:n]) * _powers(_INVERSE, n) + np.uint64(width))
