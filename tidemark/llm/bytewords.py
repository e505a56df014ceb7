"""Words and hashes of whole Arrow string columns, straight from their byte buffers.

A word is ``[^\\x20\\x09-\\x0D]+``. All separators are ASCII, so byte positions never cut a UTF-8 character.
Hashes are 64-bit polynomials over a fixed random byte table, finished by a mixer; they depend on nothing but
the bytes, so every executor and every rerun agrees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
TABLES = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SEGMENT = 1 << 18
_powers: list[np.ndarray] = []


def _power_arrays(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * _SEGMENT)
        with np.errstate(over="ignore"):
            _powers[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b))]) for b in (_BASE, _BASE_INVERSE)]
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: int = 0) -> np.ndarray:
    """A hash of ``data[s:e]`` for each pair; ``starts`` must not decrease."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(starts, base + _SEGMENT, "left")))
        stop = int(ends[lo:hi].max())
        power, inverse = _power_arrays(stop - base + 1)
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum(TABLES[table][data[base:stop]] * power[: stop - base], out=sums[1:])
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = (sums[e] - sums[s]) * inverse[s]
        lo = hi
    return mixed(out)


class Words:
    """The words of some rows: byte ranges ``starts``/``ends`` in ``data``, and per row ``first[i]:first[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        solid = ~SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before, after = np.empty_like(solid), np.empty_like(solid)
        if len(data):
            before[0], before[1:] = False, solid[:-1]
            after[-1], after[:-1] = False, solid[1:]
        self.starts = np.flatnonzero(solid & (~before | edge[:-1]))
        self.ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, table: int = 0) -> np.ndarray:
        return range_hashes(self.data, self.starts, self.ends, table)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column; a null has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def row_runs(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Rows ``lo:hi`` at a time, of about ``size`` bytes together; one longer text comes alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(ends):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + size, "right")))
        yield lo, hi
        lo = hi


def tidy(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``f`` over a task's batches, after which Arrow and the C library give back what they hold unused: Spark keeps workers for later tasks, as part of the executor."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from f(batches)
        finally:
            pa.default_memory_pool().release_unused()
            pa.system_memory_pool().release_unused()

    return run


def word_chunks(texts: pa.Array, lower: bool = False, size: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    """Rows ``lo:hi`` at a time, about ``size`` bytes together (one longer text comes alone), with their words."""
    data, offsets = buffers(texts)
    lo = 0
    while lo < len(offsets) - 1:
        hi = min(len(offsets) - 1, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1))
        part = data[offsets[lo] : offsets[hi]]
        yield lo, hi, Words(LOWER[part] if lower else part, offsets[lo : hi + 1] - offsets[lo])
        lo = hi


SHINGLE = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct hashes of its ``width``-word shingles (A-Z lower-cased).

    A text of fewer words gives its whole sequence as one shingle, a text without words none.
    """
    for lo, hi, words in word_chunks(texts, lower=True):
        h = words.hashes()
        rolled = np.zeros(max(0, len(h) - width + 1), np.uint64)
        for j in range(width):
            rolled = rolled * SHINGLE + h[j : j + len(rolled)]
        rolled = mixed(rolled)
        for i in range(hi - lo):
            a, b = words.first[i], words.first[i + 1]
            if b - a >= width:
                yield lo + i, np.unique(rolled[a : b - width + 1])
            elif b > a:
                short = np.uint64(b - a)
                for x in h[a:b]:
                    short = short * SHINGLE + x
                yield lo + i, mixed(np.array([short], np.uint64))
            else:
                yield lo + i, np.zeros(0, np.uint64)


np.seterr(over="ignore")
