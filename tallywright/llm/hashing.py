"""Rolling hashes of byte and word windows over many texts at once, in NumPy.

A window hash is a polynomial over 2**64 with an odd base, so that any window comes from two prefix
sums. Values are spread by a random table before and mixed after. Equal windows always have equal
hashes; where a decision must hold without a second look, two hashes of different bases are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bases of the polynomials; each is 5 modulo 8, so that its powers have the longest period.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED05, 0x8CB92BA72F3D8DD5)
#: Bytes of text worked on at once; a single longer text is a slice of its own.
SLICE_BYTES = 400_000
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n; grown by doubling and kept by the worker."""
    if base not in _powers or len(_powers[base][0]) <= n:
        size = 1 << max(16, int(n + 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 2**64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        _powers[base] = (both[0], both[1])
    return _powers[base]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that lets every bit depend on all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values))[0][: len(values)], out=out[1:])
    return out


def ranges(sums: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each pair, from prefix_sums(values, base)."""
    return mix((sums[end] - sums[start]) * powers(base, len(sums))[1][start] + (end - start).astype(np.uint64))


def windows(sums: np.ndarray, base: int, size: int) -> np.ndarray:
    """Hash of each window of ``size`` values."""
    n = max(0, len(sums) - size)
    return mix((sums[size : size + n] - sums[:n]) * powers(base, len(sums))[1][:n])


def byte_sums(data: np.ndarray, base: int) -> np.ndarray:
    return prefix_sums(_BYTE_VALUES[data], base)


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, UTF-8 bytes, offsets of the rows and of the end) of runs of rows; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of ``[^\\x20\\x09-\\x0D]+``, and per row the number of its first word."""
    inside = ~SPACES[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return ranges(byte_sums(data, BASES[0]), BASES[0], starts, ends)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of n positions lie in a window of ``size`` that begins at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + size, n), -1)
    return np.cumsum(steps[:-1]) > 0
