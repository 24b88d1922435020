"""Words of many texts at once: NumPy over the UTF-8 bytes of an Arrow batch.

A polynomial prefix sum over the bytes gives every word's 64-bit hash without
a Python object per word. Texts are taken in slices of about ``SLICE_BYTES``
so that memory depends on the longest text, not on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
#: Odd 64-bit constants of the hash functions; any odd numbers do.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words split at ASCII white space, and of words of ASCII letters, digits and all beyond ASCII.
NOT_SPACE = ~_SPACE
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[0x41:0x5B] += np.uint64(0x20)
SAME = np.arange(256, dtype=np.uint64)

_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least ``n`` of each."""
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, SLICE_BYTES + 1)

        def table(base: int) -> np.ndarray:
            p = np.full(size, base, np.uint64)
            p[0] = 1
            return np.multiply.accumulate(p)

        _pow, _inv = table(BASE), table(pow(BASE, -1, 1 << 64))
    return _pow, _inv


@dataclass
class Words:
    """Words of texts ``first`` to ``last`` - 1 of a batch, in text order."""

    first: int
    last: int
    hash: np.ndarray     # uint64, one per word
    doc: np.ndarray      # text of the word, counted from ``first``
    start: np.ndarray    # byte offsets into the slice's data
    end: np.ndarray
    data: np.ndarray     # bytes of the slice
    bounds: np.ndarray   # first word of each text, and the number of words

    @property
    def n_docs(self) -> int:
        return self.last - self.first


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), off.astype(np.int64)


def slices(column: pa.Array, in_word: np.ndarray, fold: np.ndarray, slice_bytes: int = SLICE_BYTES) -> Iterator[Words]:
    """Split the texts of ``column`` into words of the bytes ``in_word``,
    hashed over the bytes as ``fold`` maps them."""
    if not len(column):
        return
    data, off = _buffers(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(off, off[first] + slice_bytes, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield _split(data[off[first]:off[last]], off[first:last + 1] - off[first], first, last, in_word, fold)
        first = last


def _split(data: np.ndarray, off: np.ndarray, first: int, last: int, in_word: np.ndarray, fold: np.ndarray) -> Words:
    n = len(data)
    w = in_word[data]
    cut = np.zeros(n + 1, bool)          # a text begins here
    cut[off] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = w[:-1]
    start = np.flatnonzero(w & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = w[1:]
    end = np.flatnonzero(w & (~after | cut[1:])) + 1
    power, inverse = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((fold[data] + np.uint64(1)) * power[:n], out=total[1:])
    h = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    bounds = np.searchsorted(start, off).astype(np.int64)
    doc = np.repeat(np.arange(last - first), np.diff(bounds))
    return Words(first, last, h, doc, start, end, data, bounds)


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words within one text, and the index of
    its first word."""
    h = words.hash
    if len(h) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.doc[:len(h) - width + 1] == words.doc[width - 1:])
    g = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        g = (g + h[k:len(h) - width + 1 + k]) * np.uint64(BASE)
        g ^= g >> np.uint64(29)
    return mix(g[at]), at
