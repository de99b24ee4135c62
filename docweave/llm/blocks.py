"""Vectorised text work on Arrow blocks: bytes, words, shingles and their hashes.

A block is a run of whole documents of one Arrow batch, laid out as one byte
array.  Everything is numpy on that array; there is no loop over words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the polynomial hash and of the shingle combination.
BASE = 0x9E3779B97F4A7C15
STEP = 0xD6E8FEB86659FD93
MASK = (1 << 64) - 1
#: The ASCII white space that separates words.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SPACE)] = False
IS_ALNUM = np.zeros(256, dtype=bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    IS_ALNUM[_a : _b + 1] = True

_powers: dict[int, np.ndarray] = {}


_kept: list[Callable[[], object]] = []


def kept(clear: Callable[[], object]) -> None:
    """Name what empties a cache that a Python worker keeps from task to task."""
    _kept.append(clear)


def give_back() -> None:
    """Empty the caches that earlier tasks have left in this worker, and return its freed memory to the system.

    Workers go on from operator to operator; one that needs room begins with this.
    """
    for clear in _kept:
        clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        have = np.full(size, base, dtype=U64)
        have[0] = 1
        have = np.cumprod(have, dtype=U64)
        if size <= 1 << 24:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums of a byte array; ``span_hash`` reads hashes off them."""
    sums = np.empty(len(data) + 1, dtype=U64)
    sums[0] = 0
    np.cumsum((data.astype(U64) + U64(1)) * powers(BASE, len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], equal for equal bytes wherever they stand."""
    inverse = powers(pow(BASE, -1, 1 << 64), len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without gaps, and n + 1 offsets; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` bytes of text, at least one row each."""
    lengths = batch.column(column).cast(pa.large_binary())
    sizes = np.diff(column_bytes(lengths)[1])
    total = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the maximal runs of ``table`` bytes within rows."""
    inside = table[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    before[offsets[:-1]] = False
    after[offsets[1:]] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in order (A-Z lower-cased), and n + 1 word offsets of the rows."""
    starts, ends, rows = word_spans(data, offsets, table)
    hashes = span_hash(prefix_sums(LOWER[data]), starts, ends)
    return hashes, np.searchsorted(rows, np.arange(len(offsets)), side="left")


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words within rows, and their row numbers.

    A row with fewer than k words, but not none, has its whole sequence as one.
    """
    counts = np.diff(bounds)
    n = len(words)
    combined = np.zeros(n, dtype=U64)
    for j in range(k):
        combined[: n - j] += words[j:] * U64(pow(STEP, j + 1, 1 << 64)) if j < n else U64(0)
    rows = np.repeat(np.arange(len(counts)), counts)
    full = np.arange(n) + k <= bounds[1:][rows] if n else np.zeros(0, bool)
    out, where = mix(combined[full] + U64(k)), rows[full]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        own = np.empty(len(short), dtype=U64)
        for i, row in enumerate(short):
            part = words[bounds[row] : bounds[row + 1]]
            factors = np.array([pow(STEP, j + 1, 1 << 64) for j in range(len(part))], dtype=U64)
            own[i] = mix((part * factors).sum(dtype=U64).reshape(1) + U64(len(part)))[0]
        out, where = np.concatenate([out, own]), np.concatenate([where, short])
        order = np.argsort(where, kind="stable")
        out, where = out[order], where[order]
    return out, where
