"""Words of many texts as 64-bit codes, computed on whole Arrow buffers.

A word is a run of bytes other than blank and \\x09-\\x0D, with A-Z lowered. Its code is a polynomial
hash of its bytes, taken from prefix sums over the buffer, then mixed. Equal words have equal codes
on every machine; two different words share one with probability about 2**-64 each.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes handled at a time; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over the 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the row bounds in them; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds - (bounds[0] if len(bounds) else 0)
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]]
    return raw, bounds - bounds[0]


@dataclass
class Words:
    """The words of some consecutive rows: codes, byte spans in ``raw`` and the bounds by row."""

    first_row: int
    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    raw: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """The row of each word, counted from first_row."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words_of(raw: np.ndarray, bounds: np.ndarray, first_row: int = 0, keep: np.ndarray | None = None) -> Words:
    """``keep``: by byte, what belongs to a word, in place of the default."""
    space = _IS_SPACE[raw] if keep is None else ~keep[raw]
    n = len(raw)
    inside = ~space
    begins = np.zeros(n, dtype=bool)
    cut = bounds[(bounds > 0) & (bounds < n)]
    if n:
        begins[0] = inside[0]
        begins[1:] = inside[1:] & space[:-1]
        begins[cut] = inside[cut]
    stops = np.zeros(n + 1, dtype=bool)
    if n:
        stops[1:n] = inside[:-1] & space[1:]
        stops[n] = inside[-1]
        stops[cut] |= inside[cut - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    codes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(first_row, codes, starts, ends, np.searchsorted(starts, bounds), raw)


def chunks_of(bounds: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_chunks(column: pa.Array, keep: np.ndarray | None = None) -> Iterator[Words]:
    raw, bounds = column_bytes(column)
    for i, j in chunks_of(bounds):
        yield words_of(raw[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], i, keep)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the runs of k words and the bounds by row; a row with fewer words gives its whole
    sequence as one run, a row without words none."""
    counts = np.diff(words.bounds)
    n_runs = np.where(counts == 0, 0, np.maximum(counts - k + 1, 1))
    bounds = np.concatenate(([0], np.cumsum(n_runs)))
    if not len(words.codes):
        return np.zeros(0, np.uint64), bounds
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - words.bounds[:-1], n_runs)
    last = np.repeat(words.bounds[1:], n_runs)
    code = np.zeros(len(at), dtype=np.uint64)
    for j in range(k):
        here = at + j
        part = np.where(here < last, words.codes[np.minimum(here, len(words.codes) - 1)], np.uint64(0))
        code = mixed(code * np.uint64(0x9FB21C651E98DF25) + part + np.uint64(j + 1))
    return code, bounds
