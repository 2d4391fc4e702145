"""Vectorised byte and word access to Arrow string columns, for use in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that one step of a kernel handles; bounds its temporaries.
STEP_BYTES = 1 << 20

_SPACES = np.array([9, 10, 11, 12, 13, 32])
_MULTIPLIER = 0x9E3779B97F4A7C15


def steps(batch: pa.RecordBatch, column: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each; a longer text stands alone.

    After the last, Arrow's pool gives back what it keeps of earlier batches: a worker lives on from one step to the next, and its pool with it.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, rows = 0, batch.num_rows
    while at < rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (one more at the end); null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def not_space() -> np.ndarray:
    """Of each byte value, whether words ``[^\\x20\\x09-\\x0D]+`` hold it."""
    table = np.ones(256, bool)
    table[_SPACES] = False
    return table


def alphanumeric() -> np.ndarray:
    """Of each byte value, whether it is an ASCII letter or digit or part of a longer character."""
    table = np.zeros(256, bool)
    table[128:] = table[48:58] = table[65:91] = table[97:123] = True
    return table


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of each longest run of bytes that ``table`` (by default ``not_space``) holds."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = (not_space() if table is None else table)[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    starts, ends = offsets[:-1][full], offsets[1:][full] - 1
    first[starts] = inside[starts]
    last[ends] = inside[ends]
    begin = np.flatnonzero(first)
    return begin, np.flatnonzero(last) + 1, np.searchsorted(offsets, begin, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> np.ndarray:
    """1, m, m², ... modulo 2^64."""
    out = np.full(max(n, 1), _MULTIPLIER, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; the spans are in order and apart."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    length = end - begin
    starts = np.concatenate(([0], np.cumsum(length)[:-1]))
    within = np.arange(int(length.sum())) - np.repeat(starts, length)
    values = data[within + np.repeat(begin, length)].astype(np.uint64) + np.uint64(1)
    values *= powers(int(length.max()))[within]
    return mix(np.add.reduceat(values, starts) + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def fold(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash of two, in this order."""
    return mix(first * np.uint64(_MULTIPLIER) + second)
