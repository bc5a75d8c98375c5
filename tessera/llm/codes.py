"""Byte-level word kernels over Arrow string columns, shared by the Python-side operators.

A word is a maximal run of bytes of a class (a 256-entry table). UTF-8 keeps every
non-ASCII code point in bytes >= 0x80, so ASCII-defined word classes can be read off the
bytes without decoding. Words get a mixed 64-bit hash of their normalised bytes:
``sum((b + 1) * P**j)`` from prefix sums modulo 2**64, then a bit mixer. Work is done in
steps of about a megabyte cut at word boundaries, so memory does not follow text length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

STEP = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_P_INV = pow(_P, -1, 1 << 64)
_powers: list[np.ndarray] = []

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words of the contracts [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Words of the contracts [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ on lower-cased text
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Bit mixer of uint64 values (a bijection)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, STEP + 4096)
        tables = []
        for base in (_P, _P_INV):
            t = np.full(size, base & _MASK, dtype=np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of a column: byte range of each in ``data``, its hash, and first word of each row."""

    data: np.ndarray       # raw bytes of the column
    rows: np.ndarray       # byte offset of each row, plus the end
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray      # index of each row's first word, plus the end


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if buffers[2] is None:
        return np.empty(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = bytes_of(batch.column(text))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def _cut(data: np.ndarray, member: np.ndarray, edge: np.ndarray, at: int) -> int:
    """First position >= at between two words."""
    n = len(data)
    while at < n:
        stop = min(n, at + 4096)
        free = ~member[data[at:stop]] | edge[at:stop]
        if free.any():
            return at + int(free.argmax())
        at = stop
    return n


def words_of(column: pa.Array, member: np.ndarray, norm: np.ndarray = LOWER, step: int = STEP) -> Words:
    """Words (runs of ``member`` bytes after ``norm``) of every row, with hashes."""
    data, rows = bytes_of(column)
    n = len(data)
    known = member[norm]
    edge = np.zeros(n + 1, dtype=bool)
    edge[rows] = True
    starts, ends, hashes = [], [], []
    lo = 0
    while lo < n:
        hi = _cut(data, known, edge, min(n, lo + step))
        part = data[lo:hi]
        inside = known[part]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[lo + 1:hi]
        over = inside
        over[:-1] &= ~inside[1:] | edge[lo + 1:hi]
        s, e = np.flatnonzero(begin), np.flatnonzero(over) + 1
        power, inverse = _power_tables(hi - lo + 1)
        value = norm[part].astype(np.uint64)
        value += np.uint64(1)
        value *= power[:hi - lo]
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(value, out=total[1:])
        hashes.append(mix64((total[e] - total[s]) * inverse[s]))
        starts.append(s + lo)
        ends.append(e + lo)
        lo = hi
    start = np.concatenate(starts) if starts else np.empty(0, np.int64)
    end = np.concatenate(ends) if ends else np.empty(0, np.int64)
    hash_ = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    return Words(data, rows, start, end, hash_, np.searchsorted(start, rows))


def windows(hash_: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words (length max(0, n - width + 1))."""
    n = len(hash_) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(_P) + hash_[k:k + n]
    return mix64(out + np.uint64(width))


class Lookup:
    """Open-addressing map from uint64 keys to positions, read for whole arrays at once."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, dtype=np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 2 + 1))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.slot = np.full(1 << bits, -1, dtype=np.int32)
        self.keys = keys
        where, todo = self._home(keys), np.arange(len(keys))
        while len(todo):
            free = self.slot[where] < 0
            self.slot[where[free]] = todo[free]
            left = self.slot[where] != todo
            todo, where = todo[left], (where[left] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(_P)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 if it is absent."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int32)
        where = self._home(keys)
        out = self.slot[where]
        todo = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        where = where[todo]
        while len(todo):
            where = (where + 1) & self.mask
            got = self.slot[where]
            out[todo] = got
            left = (got >= 0) & (self.keys[got] != keys[todo])
            todo, where = todo[left], where[left]
        return out
