"""Words of UTF-8 text as 64-bit hashes, many documents at a time.

A word is a run of bytes other than 0x20 and 0x09-0x0D. UTF-8 keeps those byte
values for the characters themselves, so bytes and code points split alike. A
word's hash is a polynomial over random byte values modulo 2**64, mixed once
more. Every step is one numpy pass over a chunk of at most about a megabyte, so
memory does not grow with the length of a text; a longer word is hashed in its
own chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
U64 = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FACTOR = 0x9E3779B97F4A7C15 | 1
_ROOM: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the splitmix64 rounds)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.int64)
    if lower:
        codes[65:91] += 32
    return mix(codes.astype(U64) + U64(0x5851F42D4C957F2D))


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}
BYTE_VALUES = _VALUES[False]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The factor's powers 0..n-1 modulo 2**64, and their inverses."""
    size = max(CHUNK, 1 << max(0, n - 1).bit_length(), *_ROOM)
    if size not in _ROOM:
        _ROOM.clear()
        inverse = pow(_FACTOR, -1, 1 << 64)
        _ROOM[size] = tuple(
            np.concatenate(
                [np.ones(1, U64), np.full(size - 1, f, U64).cumprod(dtype=U64)]
            )
            for f in (_FACTOR, inverse)
        )
    up, down = _ROOM[size]
    return up[:n], down[:n]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about a chunk that end at a row's end or behind white space."""
    at, end = 0, len(data)
    while at < end:
        stop = min(end, at + CHUNK)
        row_end = offsets[np.searchsorted(offsets, stop, side="right") - 1]
        if stop < end and row_end > at:
            stop = int(row_end)
        while stop < end and stop != row_end and not SPACE[data[stop - 1]]:
            ahead = np.flatnonzero(SPACE[data[stop : stop + CHUNK]])
            row_stop = int(offsets[np.searchsorted(offsets, stop, side="left")])
            stop = min(row_stop, stop + int(ahead[0]) + 1 if len(ahead) else stop + CHUNK, end)
            row_end = row_stop
        yield at, stop
        at = stop


def words(
    column: pa.Array | pa.ChunkedArray, lower: bool = True, places: bool = False
) -> tuple[np.ndarray, ...]:
    """Hash and row of every word, in order; with ``places``, also its first byte and
    the byte behind it, counted in the row."""
    data, offsets = utf8(column)
    values = _VALUES[lower]
    hashes, rows, firsts, ends = [], [], [], []
    starts_of_rows = np.zeros(len(data) + 1, dtype=bool)
    starts_of_rows[offsets] = True
    for at, stop in _cuts(data, offsets):
        part = data[at:stop]
        solid = ~SPACE[part]
        new_row = starts_of_rows[at:stop]
        first = solid.copy()
        first[1:] &= ~solid[:-1] | new_row[1:]
        last = solid.copy()
        last[:-1] &= ~solid[1:] | new_row[1:]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        if not len(begin):
            continue
        up, down = powers(len(part))
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(values[part] * up, out=sums[1:])
        hashes.append(mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(U64)))
        row = np.searchsorted(offsets, begin + at, side="right") - 1
        rows.append(row.astype(np.int32))
        if places:
            firsts.append(begin + at - offsets[row])
            ends.append(end + at - offsets[row])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    out = (join(hashes, U64), join(rows, np.int32))
    return (*out, join(firsts, np.int64), join(ends, np.int64)) if places else out


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of n words of one row."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int32)
    total = np.zeros(count, U64)
    factor = 1
    for k in range(n):
        total += hashes[k : k + count] * U64(factor)
        factor = factor * _FACTOR % (1 << 64)
    inside = rows[:count] == rows[n - 1 :]
    return mix(total[inside]), rows[:count][inside]


def row_bounds(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """The n_rows + 1 places where each row's entries begin in the sorted ``rows``."""
    return np.searchsorted(rows, np.arange(n_rows + 1))


def blocks(
    batch: pa.RecordBatch, column: int, max_bytes: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose text comes to about ``max_bytes``, one row at least."""
    offsets = utf8(batch.column(column))[1]
    at, n = 0, batch.num_rows
    while at < n:
        stop = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        stop = min(n, max(at + 1, stop))
        yield batch.slice(at, stop - at)
        at = stop
