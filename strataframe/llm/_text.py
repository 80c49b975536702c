"""Vectorised helpers for whole texts inside Arrow tasks: bytes, spans, hashes.

A task walks its record batches in chunks of about ``CHUNK`` bytes of text, so
memory depends on the chunk and on the longest single text, never on the
partition.  Spans of bytes are hashed with a polynomial prefix hash, which
gives the hash of any span in constant time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 2 << 20

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: A fixed random 64-bit value for every byte.
BYTE_CODE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | _U64(1)

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if n <= 8 * CHUNK:  # a very long text must not stay in memory
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes: every input bit reaches every output bit."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


class Prefix:
    """Prefix sums over a sequence of 64-bit codes; ``spans`` hashes any spans of it."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes * _power(_BASE, n)[:n], out=self.sums[1:])
        self.inverse = _power(_BASE_INV, n + 1)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + length * _U64(0xD6E8FEB86659FD93))


def byte_prefix(buf: np.ndarray) -> Prefix:
    return Prefix(BYTE_CODE[buf])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n+1 offsets; a null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return buf, offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str, size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``size`` bytes of text each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def is_space(buf: np.ndarray) -> np.ndarray:
    return _SPACE[buf]


def ascii_lower(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``; words end at the end of their text."""
    solid = ~_SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True  # a text's first byte can't continue a word
    before = np.zeros(len(buf), bool)
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.zeros(len(buf), bool)
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def row_ranges(row: np.ndarray, n: int) -> np.ndarray:
    """The n+1 bounds of each row's items in a list sorted by row."""
    return np.searchsorted(row, np.arange(n + 1))


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i]+1, ... count[i] of them, one after another."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(count) - count
    return np.repeat(start - first, count) + np.arange(total)


def list_array(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)
