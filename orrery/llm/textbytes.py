"""Vectorised helpers over the UTF-8 bytes of a column of texts.

An Arrow string column is one byte buffer with offsets; words, lines and their
64-bit hashes are found with numpy over that buffer, without a Python object for
each of them. Texts are taken in slices of bounded size, so memory does not follow
the size of a batch; only a single text longer than the bound exceeds it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MUL2 = np.uint64(0xD6E8FEB86659FD93)
_LONG = 64
_MASK = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive ranges of the texts with about ``limit`` bytes each."""
    if not len(texts):
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(sizes):
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + limit, "right")))
        yield texts.slice(start, end - start)
        start = end


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the n + 1 offsets of the texts in them; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


class Runs(NamedTuple):
    """Byte ranges [start, end) of words or lines, and for each text the index of its first one (n + 1 entries)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def release() -> None:
    """Hand memory that is no longer used back to the system. Python workers live on between
    tasks of many kinds, and what one kind needed would otherwise stay with them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def words(raw: np.ndarray, off: np.ndarray) -> Runs:
    """Words: longest runs of bytes other than ASCII white space."""
    n = len(raw)
    ink = np.zeros(n + 1, bool)
    ink[:n] = ~SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.zeros(n + 1, bool)
    before[1:] = ink[:-1]
    start = np.flatnonzero(ink & (~before | edge))
    end = np.flatnonzero(before & (~ink | edge))
    return Runs(start, end, np.searchsorted(start, off))


def lines(raw: np.ndarray, off: np.ndarray) -> Runs:
    """Lines of each text: what ``\\n`` separates, the separator left out; an empty text has one empty line."""
    breaks = np.flatnonzero(raw == 10)
    start = np.sort(np.concatenate([off[:-1], breaks + 1]), kind="stable")
    own = np.searchsorted(breaks, off)
    first = np.arange(len(off)) + own
    # a break at the last byte of a text opens a line at the next text's offset: both starts are equal, and in order
    end = np.empty(len(start), np.int64)
    end[:-1] = start[1:] - 1
    last = first[1:] - 1
    end[last] = off[1:]
    return Runs(start, end, first)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * _MUL2
    h = h ^ (h >> np.uint64(29))
    h = h * _MUL
    return h ^ (h >> np.uint64(32))


def hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of the bytes of each range: eight bytes at a step, long ranges by xxhash."""
    size = end - start
    out = np.full(len(start), seed, np.uint64) ^ (size.astype(np.uint64) * _MUL)
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[:len(raw)] = raw
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    todo = np.flatnonzero((size > 0) & (size <= _LONG))
    at = 0
    while len(todo):
        left = size[todo] - at
        w = eight[start[todo] + at] & _MASK[np.minimum(left, 8)]
        h = (out[todo] ^ w) * _MUL
        out[todo] = h ^ (h >> np.uint64(31))
        at += 8
        todo = todo[left > 8]
    whole = memoryview(raw) if raw.flags.c_contiguous else memoryview(raw.copy())
    for i in np.flatnonzero(size > _LONG):
        out[i] ^= np.uint64(xxhash.xxh3_64_intdigest(whole[start[i]:end[i]], seed))
    return mix(out)


def windows(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``width`` consecutive items within a text, and the index of each window's first item."""
    n = len(h)
    if n < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = h[:n - width + 1].copy()
    for k in range(1, width):
        acc = mix(acc * _MUL + h[k:n - width + 1 + k])
    item = np.arange(n - width + 1)
    left = np.repeat(first[1:], np.diff(first))[:n - width + 1] - item
    keep = left >= width
    return acc[keep], item[keep]


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]
