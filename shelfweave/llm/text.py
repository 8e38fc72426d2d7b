"""Words, hashes and shingles of whole texts, worked out for many documents at once on the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as doubles above 0 and up to 1."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2^64."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, null as empty, and where each row begins and ends in them."""
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column, b"" if binary else "").cast(pa.large_binary() if binary else pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def parts(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``most`` bytes (one row at least): first row, row after the last, bytes, row offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, at = text_bytes(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


class Words(NamedTuple):
    start: np.ndarray  # byte where the word begins
    end: np.ndarray  # byte after it
    hash: np.ndarray
    doc: np.ndarray  # row of the word
    first: np.ndarray  # first word of each row, and the number of words


def words(data: np.ndarray, at: np.ndarray) -> Words:
    """Runs of bytes other than ASCII white space; no word spans two rows."""
    n = len(at) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none.astype(np.uint64), none, np.zeros(n + 1, np.int64))
    solid = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    value = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    first = np.searchsorted(start, at)
    return Words(start, end, value, np.repeat(np.arange(n), np.diff(first)), first)


def shingles(w: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words, the row of each and its first word; a row of fewer words (but one) has one shingle of all."""
    n = len(w.hash)
    number = np.diff(w.first)
    place = np.arange(n) - w.first[w.doc] if n else np.zeros(0, np.int64)
    left = (number[w.doc] if n else place) - place
    begins = (left >= k) | ((place == 0) & (left < k))
    value = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        c = np.uint64(((2 * j + 1) * 0xD1342543DE82EF95) & ((1 << 64) - 1))
        there = left > j
        value[: n - j] += np.where(there[: n - j], w.hash[j:] * c, np.uint64(0))
    keep = np.flatnonzero(begins)
    return mix(value[keep]), w.doc[keep], keep


def counted(value: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs in order, with how often each occurs."""
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return value[at], doc[at], np.diff(np.append(at, len(value)))
