"""Vectorised word handling on Arrow batches, shared by the text operators.

A word is a run of characters outside ``\\x20\\x09-\\x0D``; only A-Z are lower-cased. Both rules
work on single bytes, so whole batches are handled as byte arrays.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
TEXT_ROWS = 2000  # whole texts in a batch that goes to Python
TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACES = b"\t\n\v\f\r "


def tidy() -> None:
    """Give free memory back to the system: a worker lives on for other tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if TRIM is not None:
        TRIM(0)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each; one row at least."""
    for batch in batches:
        tidy()
        n = batch.num_rows
        if not n:
            continue
        texts = batch.column(column)
        at = _offsets(texts)[0]
        start = 0
        while start < n:
            stop = int(np.searchsorted(at, at[start] + limit, side="right")) - 1
            stop = min(n, max(stop, start + 1))
            yield batch.slice(start, stop - start)
            start = stop
        batch = texts = None
    tidy()


def _offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = pa.types.is_large_string(texts.type)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if at else np.zeros(len(texts) + 1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and the row offsets into them; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    offsets, data = _offsets(texts)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of the rows, in order, and the offsets of the rows into them."""
    return located_words(texts, lower)[:2]


def located_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """As ``words``, with the byte at which each word begins, counted from the first row."""
    data, at = text_bytes(texts)
    inside = (data != 32) & (data - np.uint8(9) > 4)  # bytes below 9 wrap round
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = at[:-1] < at[1:]
    first, last = at[:-1][full], at[1:][full] - 1
    begins[first], ends[last] = inside[first], inside[last]
    where = np.flatnonzero(begins)
    offsets = np.zeros(len(where) + 1, np.int32)
    np.cumsum(np.flatnonzero(ends) - where + 1, out=offsets[1:])
    flat = pa.Array.from_buffers(pa.binary(), len(where), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes().translate(_LOWER.tobytes() if lower else None, _SPACES))])
    return flat, np.searchsorted(where, at), where


def encoded(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row numbers into the distinct values, and those values."""
    d = flat.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False), d.dictionary


def hashes(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each binary value, the same on every machine: the length and then eight bytes at a time are mixed in."""
    n = len(values)
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int32)[values.offset : values.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[: ends[-1]] if data is not None else np.zeros(0, np.uint8)
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    at, left = ends[:-1], np.diff(ends)
    out = mix((left.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    use = np.flatnonzero(left > 0)
    at, left = at[use], left[use]
    while len(use):
        part = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)))
        out[use] = mix(out[use] * np.uint64(0x9E3779B97F4A7C15) + part)
        more = np.flatnonzero(left > 8)
        use, at, left = use[more], at[more] + 8, left[more] - 8
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (fixed values)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(token: np.ndarray, at: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles and the offsets of the rows into them.

    A row with fewer words than ``width`` has its whole sequence as one shingle; a row without
    words has none.
    """
    n = np.diff(at)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out = np.zeros(int(count.sum()), np.uint64)
    bounds = np.concatenate([[0], np.cumsum(count)])
    step = np.uint64(0x9E3779B97F4A7C15)
    total = len(token)
    if total >= width:
        roll = np.zeros(total - width + 1, np.uint64)
        for k in range(width):
            roll = (roll + token[k : total - width + 1 + k]) * step
            roll ^= roll >> np.uint64(29)
        full = n >= width
        source = np.repeat(at[:-1][full] - bounds[:-1][full], count[full])
        target = np.flatnonzero(np.repeat(full, count))
        out[target] = mix(roll[target + source])
    for row in np.flatnonzero((n > 0) & (n < width)):
        h = np.array([n[row]], np.uint64)
        for k in range(at[row], at[row + 1]):
            h = (h + token[k : k + 1]) * step
            h ^= h >> np.uint64(29)
        out[bounds[row]] = mix(h + np.uint64(1))[0]
    return out, bounds


def long_column(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))
