"""Vectorised words and word shingles of UTF-8 text, as 64-bit hashes.

A task's Arrow batch is one byte buffer; every step below is a few numpy passes
over it, so no Python object is made for a word. Words are runs of bytes other
than space and \\x09-\\x0D, after lower-casing A-Z. These are all ASCII, so byte
positions never split a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers = (tables[0], tables[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sums whose differences are polynomial hashes of byte ranges."""
    powers, _ = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent hashes of ``data[start:end]``; lengths are part of them."""
    _, inverse = _power_tables(len(sums))
    polynomial = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(polynomial + (ends - starts).astype(np.uint64) * _MIX[1])


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its rows' offsets into them; a null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends and hashes of all words, and each row's range of words."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lower = LOWER[data]
    inside = ~_IS_SPACE[lower]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    # A row's first byte starts a word even when the row before ends inside one.
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = inside[firsts]
    starts = np.flatnonzero(begins)
    finish = np.ones(len(data), bool)
    finish[:-1] = ~inside[1:] | begins[1:]
    ends = np.flatnonzero(inside & finish) + 1
    hashes = range_hashes(prefix_sums(lower), starts, ends)
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def shingles(word_hashes: np.ndarray, bounds: np.ndarray, size: int = SHINGLE_WORDS):
    """Shingle hashes of all rows and each row's range of them.

    A row with fewer words than ``size`` has its whole sequence as one shingle; a
    row without words has none.
    """
    counts = np.diff(bounds)
    per_row = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(per_row)])
    n = len(word_hashes)
    padded = np.concatenate([word_hashes, np.zeros(size, np.uint64)])
    rolling = np.zeros(n, np.uint64)
    for k in range(size):
        rolling = mix(rolling + padded[k : k + n] + np.uint64(k + 1))
    rows = np.repeat(np.arange(len(counts)), per_row)
    at = np.arange(out_bounds[-1]) - out_bounds[rows] + bounds[rows]
    out = rolling[at]
    for row in np.flatnonzero((counts > 0) & (counts < size)):
        value = np.zeros(1, np.uint64)
        for k in range(counts[row]):
            value = mix(value + word_hashes[bounds[row] + k] + np.uint64(k + 1))
        # Mixed once more with its length: a short row never equals a full shingle.
        out[out_bounds[row]] = mix(value + np.uint64(counts[row]))[0]
    return out, out_bounds


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """The batch in pieces of about ``limit`` bytes of text; a longer text is a piece of its own."""
    sizes = np.diff(column_bytes(batch.column(column))[1])
    begin, size = 0, 0
    for at, n in enumerate(sizes.tolist()):
        if at > begin and size + n > limit:
            yield batch.slice(begin, at - begin)
            begin, size = at, 0
        size += n
    if begin < batch.num_rows:
        yield batch.slice(begin)
