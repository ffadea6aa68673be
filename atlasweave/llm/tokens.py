"""Vectorised word scanning over Arrow string buffers.

A batch of texts is one byte buffer with offsets.  Words are found and hashed
with numpy over that buffer, so no Python object exists per word.  Buffers are
worked through in blocks of whole documents of about ``BLOCK`` bytes, which
bounds memory whatever the batch size; a longer document is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U64 = np.uint64

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_BASE = int(_RNG.integers(2**61, 2**62)) * 2 + 1
_INVERSE = pow(_BASE, -1, 2**64)
_STEP = _RNG.integers(1, 2**63, 16, dtype=np.uint64) * U64(2) + U64(1)

#: Word bytes: all but blank, tab, LF, VT, FF, CR.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Word bytes: ASCII letters and digits and every byte of a longer UTF-8 sequence.
ALNUM = np.zeros(256, dtype=bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    ALNUM[_a:_b] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (a bijection)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(30))
        x = x * U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        size = max(n, 2 * BLOCK)
        out = np.full(size, _BASE if kind == "up" else _INVERSE, dtype=np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        _powers[kind] = out
    return _powers[kind]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 offsets of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1] if offsets is not None and len(column) else np.zeros(1, kind)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at.astype(np.int64)


def blocks(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes each, or of one row."""
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


@dataclass
class Words:
    """Words of the rows of one block, in order."""

    data: np.ndarray  # bytes of the block, A-Z lowered
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    first: np.ndarray  # n_rows + 1: words of row i are first[i]:first[i + 1]
    row_at: np.ndarray  # n_rows + 1: bytes of row i are data[row_at[i]:row_at[i + 1]]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word; equal words have equal hashes anywhere."""
        return span_hashes(self.data, self.start, self.end)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans data[start:end]."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.empty(len(data) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(_BYTE[data] * _power("up", len(data))[: len(data)], out=total[1:])
        got = (total[end] - total[start]) * _power("down", len(data))[start]
    return mix(got)


def words(raw: np.ndarray, offsets: np.ndarray, lo: int, hi: int, inside: np.ndarray = SPACED) -> Words:
    """Words of rows lo:hi; ``inside`` says which bytes belong to words."""
    at = offsets[lo : hi + 1] - offsets[lo]
    data = LOWER[raw[offsets[lo] : offsets[hi]]]
    n = len(data)
    mask = inside[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True  # a word ends where its row ends
    before = np.empty(n + 1, dtype=bool)
    before[0] = False
    before[1:] = mask
    after = np.empty(n + 1, dtype=bool)
    after[n] = False
    after[:n] = mask
    start = np.flatnonzero(after & (edge | ~before))
    end = np.flatnonzero(before & (edge | ~after))
    return Words(data, start, end, np.searchsorted(start, at), at)


def ngrams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within rows, and the index of each run's first word."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(hashes) - n + 1
    with np.errstate(over="ignore"):
        out = hashes[:m] * _STEP[0]
        for j in range(1, n):
            out += hashes[j : j + m] * _STEP[j]
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    ok = np.flatnonzero(row[:m] == row[n - 1 :]) if n > 1 else np.arange(m)
    return mix(out[ok]), ok


def shingle_sets(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-word shingles of each row, one after another, and their n_rows + 1 bounds.

    A row of fewer words has its whole sequence as one shingle; without words, none.
    """
    hashes, counts = w.hashes(), w.counts
    got, at = ngrams(hashes, w.first, n)
    row = np.searchsorted(w.first, at, side="right") - 1
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        with np.errstate(over="ignore"):
            extra = np.array([mix(np.add.reduce(hashes[a : a + c] * _STEP[:c], keepdims=True) + U64(c))[0] for a, c in zip(w.first[short], counts[short], strict=True)], dtype=np.uint64)
        got, row = np.concatenate([got, extra]), np.concatenate([row, short])
    order = np.lexsort((got, row)) if len(short) else _sort_within(got, row)
    got, row = got[order], row[order]
    keep = np.ones(len(got), dtype=bool)
    keep[1:] = (got[1:] != got[:-1]) | (row[1:] != row[:-1])
    got, row = got[keep], row[keep]
    return got, np.searchsorted(row, np.arange(len(counts) + 1))


def _sort_within(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    first = np.argsort(values)
    return first[np.argsort(row[first], kind="stable")]


class Index:
    """Open addressing from distinct 64-bit keys to rows of value arrays, for many lookups at once."""

    EMPTY = U64(2**64 - 1)

    def __init__(self, keys: np.ndarray):
        self.shift = U64(64 - max(8, int(2 * len(keys) + 1).bit_length()))
        self.size = 1 << (64 - int(self.shift))
        self.keys = np.full(self.size, self.EMPTY, dtype=np.uint64)
        self.rows = np.zeros(self.size, dtype=np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        slot = self.slot(keys)
        while len(left):
            free = self.keys[slot] == self.EMPTY
            first = np.unique(slot[free], return_index=True)[1]
            taken = np.flatnonzero(free)[first]
            self.keys[slot[taken]], self.rows[slot[taken]] = keys[left[taken]], left[taken]
            rest = np.ones(len(left), dtype=bool)
            rest[taken] = False
            left, slot = left[rest], (slot[rest] + 1) % self.size

    def slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * U64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        slot = self.slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.rows[slot], np.int32(-1))
        open_ = np.flatnonzero((held != keys) & (held != self.EMPTY))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) % self.size
            held = self.keys[slot]
            hit = held == keys[open_]
            out[open_[hit]] = self.rows[slot[hit]]
            go = ~hit & (held != self.EMPTY)
            open_, slot = open_[go], slot[go]
        return out
