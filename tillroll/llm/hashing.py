"""Whole Arrow columns of texts as NumPy arrays: words, lines and rolling hashes without a Python loop.

A hash of ``data[a:b]`` is the difference of two prefix sums of byte values times powers of an odd
number, shifted back by the inverse power, modulo 2**64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once inside a task; a longer single text makes a block of its own.
BLOCK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(keep) -> np.ndarray:
    return np.array([keep(b) for b in range(256)], dtype=bool)


#: Bytes of words ``[^\x20\x09-\x0D]+``.
VISIBLE = byte_set(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a text in lower case.
LETTERS = byte_set(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its texts (one more than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, values = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of text."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def trimmed(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``run``, and after it the worker's freed memory goes back to the system: workers are kept for later
    tasks, and while they wait the executor needs the room."""

    def inner(batches: Iterable) -> Iterator:
        yield from run(batches)
        trim()

    return inner


def trim() -> None:
    pa.default_memory_pool().release_unused()
    if trim_heap := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim_heap(0)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """``size`` powers at least; a block of ``BLOCK_BYTES`` needs one more than its bytes."""
    return _powers((1 << max(BLOCK_BYTES.bit_length() - 1, int(size - 2).bit_length())) + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit hash."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Rolling:
    """Hashes of any stretches of ``data``."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * self.up[: len(data)], out=self.sums[1:])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))

    def grams(self, size: int) -> np.ndarray:
        """The hash of ``data[i:i+size]`` for every i."""
        n = max(0, len(self.sums) - size)
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n]) if n else np.zeros(0, np.uint64)


class Words:
    """The words of a block of texts: maximal stretches of ``members`` bytes inside one text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, members: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = members[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        self.inside = inside
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        #: Number of the first word of each text, and the number of words at the end.
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def hashes(self, rolling: Rolling | None = None) -> np.ndarray:
        return (rolling or Rolling(self.data)).between(self.starts, self.ends)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words with one space after each: bytes, word starts, word ends."""
        lengths = self.ends - self.starts
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
        out[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)] = self.data[self.inside]
        return out, starts, ends


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of ``size`` consecutive word hashes, from each word that has so many after it."""
    n = max(0, len(words) - size + 1)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h *= _BASE
        h += words[k : k + n]
    return mix(h)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (lengths[0] numbers), starts[1], ..."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = starts - np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.arange(total, dtype=np.int64) + np.repeat(shift, lengths)
