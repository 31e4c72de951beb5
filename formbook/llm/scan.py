"""Vectorised scans over text bytes: word spans, window hashes, sliding minima.

All functions take and return numpy arrays; tasks call them on batches of rows.
Hashes are polynomials modulo 2**64 over random tables, finished by a mixer.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
CHUNK_BYTES = 1 << 20

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_TABLES = tuple(np.random.Generator(np.random.PCG64(s)).integers(0, 1 << 64, 256, np.uint64) for s in (11, 29))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the lane's base and of its inverse."""
    if lane not in _powers or len(_powers[lane][0]) <= n:
        size = max(n + 1, 2 * CHUNK_BYTES)
        both = []
        for base in (_BASES[lane], pow(_BASES[lane], -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        if size > 2 * CHUNK_BYTES:
            return both[0][: n + 1], both[1][: n + 1]
        _powers[lane] = (both[0], both[1])
    up, down = _powers[lane]
    return up[: n + 1], down[: n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _sums(values: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _power(lane, len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums, down


def rolling(values: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """Hash of every window of ``width`` values; empty if there are fewer."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    sums, down = _sums(values, lane)
    return mix((sums[width:] - sums[:-width]) * down[: len(values) - width + 1])


def byte_values(data: np.ndarray, lane: int = 0) -> np.ndarray:
    return _TABLES[lane][data]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes outside ``[\\x20\\x09-\\x0D]``."""
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~SPACE[data]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of the bytes in each span."""
    sums, down = _sums(byte_values(data, lane), lane)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values."""
    if len(values) < width:
        return values[:0]
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def as_bytes(column: pa.Array) -> pa.Array:
    """Text as binary, null as empty."""
    return column.cast(pa.binary()).fill_null(b"")


def slices(batches, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in short slices, so that a task holds few rows as Python objects."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def groups_of(sizes: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes; a larger row comes alone."""
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)
