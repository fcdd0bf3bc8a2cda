"""Vectorised work on the UTF-8 bytes of a batch of texts (numpy, inside tasks).

A batch is ``data`` (all bytes, one text after the other) and ``offsets`` (n + 1
starts). Words are maximal runs of bytes other than space and \\x09-\\x0D, as in the
pattern ``[^\\x20\\x09-\\x0D]+``; those bytes never occur inside a multi-byte
character. Hashes are 64 bits and the same on every machine.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes worked on at once; temporary arrays take some 50 times as much.
SLICE_BYTES = 1 << 19


def mix(x):
    """The finaliser of splitmix64: a bijection on 64-bit values."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column):
    """(data, offsets) of an Arrow string or binary array; null counts as empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64, count=column.offset + n + 1)[column.offset:]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets, limit=SLICE_BYTES):
    """Ranges (i, j) of whole texts holding about ``limit`` bytes each (one text may hold more)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def lower(data):
    """A-Z in lower case; every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_bounds(data, offsets):
    """Starts and ends of the words; words never cross texts."""
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Hasher:
    """Hashes of substrings in constant time, from one pass over the bytes."""

    def __init__(self):
        self.table = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(BASE))
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _powers(self, n):
        if len(self.up) <= n:
            size = max(n + 1, 1 << 16)
            factor = np.full(size, BASE, np.uint64)
            factor[0] = 1
            self.up = np.cumprod(factor)
            factor = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
            factor[0] = 1
            self.down = np.cumprod(factor)

    def prefix(self, data):
        n = len(data)
        self._powers(n)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:n], out=out[1:])
        return out

    def spans(self, prefix, starts, ends):
        return mix((prefix[ends] - prefix[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(hasher, data, offsets):
    """(first word of each text plus the total, hashes of the lower-cased words)."""
    starts, ends = word_bounds(data, offsets)
    first = np.searchsorted(starts, offsets, side="left")
    if len(starts) == 0:
        return first, np.zeros(0, np.uint64)
    return first, hasher.spans(hasher.prefix(lower(data)), starts, ends)


def ngram_hashes(words, n):
    """Hash of every run of ``n`` words (n >= 1) in a sequence of word hashes."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(BASE) + words[i:i + m])
    return out


def letter_bounds(data, offsets):
    """Starts and ends of the runs of ASCII letters, digits and non-ASCII bytes; punctuation separates."""
    word = (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 65) & (data <= 90)) | ((data >= 48) & (data <= 57))
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last[:-1] &= ~word[1:] | edge[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1
