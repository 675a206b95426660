"""Texts as numpy arrays inside Arrow batches: blocks of UTF-8 bytes, word spans,
and hashes of spans for whole blocks at once.

Words are runs of bytes other than ``[\\x20\\x09-\\x0D]``; upper-case A-Z count as
lower-case. A span's hash is a polynomial over its lower-cased bytes, taken from
prefix sums modulo 2^64 and mixed.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19



def released(run: Callable) -> Callable:
    """For a task's function over Arrow batches: when it ends, memory that Arrow and the C library still hold goes back to the
    system, since Spark keeps the worker for later tasks."""
    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)
    return wrapped


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix((LOWER.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


class Powers:
    """Powers of the base and of its inverse, as long as the longest block so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, BLOCK_BYTES + (BLOCK_BYTES >> 2))
            self.up, self.down = np.full((2, size), [[_BASE], [_BASE_INVERSE]], np.uint64)
            for x in (self.up, self.down):
                x[0] = 1
                np.cumprod(x, out=x)
        return self.up, self.down


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1] or b"", np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows of about ``limit`` bytes; a longer row is its own block."""
    yield from _row_runs(*string_buffers(column), limit)


def _row_runs(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def per_row(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the ascending positions lie in each row."""
    return np.diff(np.searchsorted(positions, offsets))


def cut_blocks(column: pa.Array, limit: int = BLOCK_BYTES, space: np.ndarray = SPACE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each piece, whether it is the row's last, bytes, offsets) of runs of pieces of about ``limit`` bytes. Rows are one piece
    each but for those longer than ``limit``: these are cut after a byte that parts words, so a word is never cut."""
    data, offsets = string_buffers(column)
    for first, end, own, at in _row_runs(data, offsets, limit):
        if end - first > 1 or len(own) <= limit:
            yield np.arange(first, end), np.ones(end - first, bool), own, at
            continue
        a = 0
        while a < len(own):
            b = min(a + limit, len(own))
            while b < len(own) and not space[own[b - 1]]:
                gap = np.flatnonzero(space[own[b:b + limit]])
                b = b + int(gap[0]) + 1 if len(gap) else min(b + limit, len(own))
            yield np.array([first]), np.array([b == len(own)]), own[a:b], np.array([0, b - a])
            a = b


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each row's number of words."""
    solid = ~space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = solid.copy(), solid.copy()
    if len(data):
        begins[1:] &= ~solid[:-1] | edge[1:-1]
        ends[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, per_row(starts, offsets)


def prefix_sums(data: np.ndarray, powers: Powers, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    up, _ = powers.upto(len(data))
    np.cumsum(values[data] * up[:len(data)], out=sums[1:], dtype=np.uint64)
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    _, down = powers.upto(len(sums) - 1)
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, and each row's number of words."""
    starts, ends, counts = word_spans(data, offsets, space)
    return span_hashes(prefix_sums(data, powers), starts, ends, powers), starts, ends, counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """Each row's distinct hashes of ``size`` successive words, ascending; a row with fewer words has the whole sequence as one."""
    weights = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
    n = max(0, len(words) - size + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(size):
        runs += words[k:k + n] * weights[k]
    runs = mix(runs)
    out, at = [], 0
    for c in counts.tolist():
        if c >= size:
            own = np.sort(runs[at:at + c - size + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif c:
            out.append(mix((words[at:at + c] * weights[:c]).sum(dtype=np.uint64, keepdims=True) + np.uint64(c)))
        else:
            out.append(words[:0])
        at += c
    return out


def code_points(data: np.ndarray) -> np.ndarray:
    """Number of code points before each byte position (one longer than ``data``)."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def lookup(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in the ascending table, -1 where it isn't there."""
    if not len(table) or not len(keys):
        return np.full(len(keys), -1, np.int64)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return np.where(table[at] == keys, at, -1)


def hash_table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open-addressing table of distinct, non-zero, well mixed keys: at least half of the slots stay free (key 0)."""
    bits = max(4, int(2 * len(keys)).bit_length())
    slots, held = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, values.dtype)
    at, todo = (keys >> np.uint64(64 - bits)).astype(np.int64), np.arange(len(keys))
    while len(todo):
        p = at[todo]
        free = slots[p] == 0
        slots[p[free]] = keys[todo[free]]
        done = slots[p] == keys[todo]
        held[p[done]] = values[todo[done]]
        todo = todo[~done]
        at[todo] = (at[todo] + 1) & ((1 << bits) - 1)
    return slots, held


def table_get(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in the table, and their values (0 where they aren't)."""
    slots, held = table
    at = (keys >> np.uint64(65 - len(slots).bit_length())).astype(np.int64)
    seen = slots[at]
    found = seen == keys
    todo = np.flatnonzero(~found & (seen != 0))
    while len(todo):
        at[todo] = (at[todo] + 1) & (len(slots) - 1)
        seen = slots[at[todo]]
        same = seen == keys[todo]
        found[todo[same]] = True
        todo = todo[~same & (seen != 0)]
    return found, np.where(found, held[at], held.dtype.type(0))
