"""Words of UTF-8 texts as numpy arrays, for use inside Arrow tasks.

A batch of texts is one byte buffer with row offsets; words are found by a
byte-class table and hashed eight bytes at a time, so the work per text is a
few vector operations instead of a Python loop.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Byte classes.  Fixed values of the word rules: white space is \x20 and
# \x09-\x0D; ASCII lower case maps A-Z only.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)
CHUNK_BYTES = 4 << 20
TABLE_WORDS = 1_000_000  # distinct words kept per Python worker (about 200 MB)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def release_memory() -> None:
    """Give freed buffers back to the system at the end of a task: a Python worker
    serves later stages too, and would keep them beside what those need."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(ctypes.util.find_library("c"))
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


@dataclass
class Texts:
    """Some rows of a batch: their bytes, ``offsets[i]:offsets[i+1]`` per row."""

    first: int          # index of the first row in the batch
    data: np.ndarray    # uint8
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def texts(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column (nulls as empty) in slices of about ``max_bytes``; a longer
    single text is one slice."""
    col = pc.fill_null(column, "").cast(pa.large_string())
    if not len(col):
        return
    _, off, raw = col.buffers()
    off = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1)
        hi = min(hi, len(col))
        yield Texts(lo, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi


def spans(t: Texts, outside: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of the words of all rows; the words of
    row ``i`` are ``first[i]:first[i+1]``."""
    n = len(t.data)
    edge = np.zeros(n + 2, dtype=bool)          # inside a word, with a border
    edge[1:n + 1] = ~outside[t.data]
    inside = edge[1:n + 1]
    starts = inside & ~edge[:n]
    ends = inside & ~edge[2:]
    cuts = t.offsets[:-1][t.offsets[:-1] < n]   # a row's first byte starts a word of its own
    starts[cuts] = inside[cuts]
    last = t.offsets[1:][t.offsets[1:] > 0] - 1
    ends[last] = inside[last]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(s, t.offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per span, eight bytes a step."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    length = ends - starts
    h = mix(length.astype(np.uint64) * _M1 + _M1)
    at, live = starts, np.arange(len(starts))
    left = length
    while len(live):
        part = eight[at]
        short = np.flatnonzero(left < 8)
        part[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[live] = mix((h[live] ^ part) * _M1)
        go = left > 8
        live, at, left = live[go], at[go] + 8, left[go] - 8
    return h


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash per tuple of hashes; the order of the parts matters."""
    h = parts[0]
    for p in parts[1:]:
        h = mix(h * _M1 + p)
    return mix(h + _M1)


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of every word, from the rows' first word indexes."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i+1]]`` per row (empty rows: 0)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


class WordTable(dict):
    """A value per word, made on first use; emptied when full."""

    def __init__(self, make: Callable[[bytes], bytes]):
        self.make = make

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= TABLE_WORDS:
            self.clear()
        value = self[word] = self.make(word)
        return value
