"""Words of whole text columns as numpy arrays: where they lie, and a 64-bit hash of each.

Texts arrive as Arrow columns, so that a batch is one run of UTF-8 bytes with row offsets. Classes of
bytes decide what a word is; every byte of a non-ASCII character is 0x80 or more, so a class of
characters that holds all or none of the non-ASCII ones is a class of bytes. Memory is bounded by the
slice: `slices` cuts a batch by bytes, and `spans` works through a slice in short blocks.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
BLOCK = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# a-z, 0-9 and everything beyond ASCII, after A-Z became a-z.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
# Everything but ASCII white space.
SOLID_BYTES = np.ones(256, bool)
SOLID_BYTES[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint64)
LOWER[0x41:0x5B] += 0x20
SAME = np.arange(256, dtype=np.uint64)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


POWERS, INVERSES = powers(BASE, BLOCK + 1), powers(BASE_INVERSE, BLOCK + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a fixed bijection)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


@dataclass
class Column:
    """Bytes of a slice of texts; row r has data[offsets[r]:offsets[r + 1]]. Null texts are empty."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> str:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes().decode("utf-8", "replace")


def column(array: pa.Array) -> Column:
    array = array.cast(pa.large_binary()).fill_null(b"")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Column(data[offsets[0] : offsets[-1]], offsets - offsets[0])


Reader = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(read: Reader) -> Reader:
    """`read`, giving back what memory it freed when it ends: Spark keeps its Python workers for later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from read(batches)
        finally:
            pa.default_memory_pool().release_unused()
            # Of glibc; other C libraries do without.
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def slices(batch: pa.RecordBatch, name: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows, each of about `limit` bytes of text or a single row."""
    offsets = column(batch.column(name)).offsets
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def cuts(inside: np.ndarray) -> Iterator[tuple[int, int]]:
    """Blocks of bytes that cut no word, unless a single word is longer than a block."""
    n, at = len(inside), 0
    while at < n:
        end = min(n, at + BLOCK)
        if end < n:
            back = np.flatnonzero(~inside[at:end])
            if len(back):
                end = at + int(back[-1]) + 1
            else:
                while end < n and inside[end]:
                    ahead = np.flatnonzero(~inside[end : end + BLOCK])
                    end = end + int(ahead[0]) if len(ahead) else min(n, end + BLOCK)
        yield at, end
        at = end


def spans(
    col: Column, member: np.ndarray, fold: np.ndarray, apart: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (in bytes of the slice) and hash of each word, and each row's first word (rows + 1 entries).

    A word is a longest run of bytes of `member` in one row; `fold` maps bytes before hashing. Another
    word begins at each position of `apart`.
    """
    n = len(col.data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), np.zeros(len(col) + 1, np.int64)
    inside = member[col.data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = col.offsets[(col.offsets > 0) & (col.offsets < n)]
    begins[edge] = inside[edge]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edge - 1] = inside[edge - 1]
    if apart is not None:
        begins[apart] = True
        ends[apart - 1] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = np.empty(len(start), np.uint64)
    for a, b in cuts(inside):
        lo, hi = np.searchsorted(start, (a, b))
        if hi == lo:
            continue
        power, inverse = (POWERS, INVERSES) if b - a <= BLOCK else (powers(BASE, b - a + 1), powers(BASE_INVERSE, b - a + 1))
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((fold[col.data[a:b]] + np.uint64(1)) * power[: b - a], out=total[1:])
        s, e = start[lo:hi] - a, end[lo:hi] - a
        hashes[lo:hi] = (total[e] - total[s]) * inverse[s]
    return start, end, mix(hashes + (end - start).astype(np.uint64)), np.searchsorted(start, col.offsets)


def words(col: Column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words: `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z became a-z."""
    return spans(col, WORD_BYTES, LOWER)


def grams(hashes: np.ndarray, steps: tuple[int, ...]) -> np.ndarray:
    """For each position a hash of the words at position + 0 and + steps; as many as there is room for."""
    n = len(hashes) - max(steps, default=0)
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n] * np.uint64(3)
    for k, step in enumerate(steps):
        out = mix(out) * BASE + hashes[step : step + n] + np.uint64(k + 1)
    return mix(out)
