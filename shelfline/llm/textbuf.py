"""Words and their hashes over whole Arrow text buffers, without a Python step per word.

An Arrow string array is one byte buffer with offsets. `blocks` cuts it into runs of whole texts of
about a megabyte (a longer text makes a block of its own), so numpy temporaries stay a small
multiple of that. A word's hash is a polynomial in an odd base modulo 2^64 over per-byte random
values, taken as a difference of prefix sums, then mixed.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 4096
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered(values: np.ndarray) -> np.ndarray:
    """A byte table with A-Z mapped to a-z."""
    out = values.copy()
    out[65:91] = values[97:123]
    return out


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
LOWER_VALUES = lowered(BYTE_VALUES)
TABLE = 2 * BLOCK_BYTES


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def kept(name: str, make: Callable[[], object]):
    """A value made once per worker process. It lives beside the code, so functions travel without it."""
    store = sys.modules.setdefault("shelfline_worker_values", types.ModuleType("shelfline_worker_values")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64; a worker keeps the table for blocks of usual size."""
    if n > TABLE:
        return _power_table(base, n)
    return kept(f"powers of {base}", lambda: _power_table(base, TABLE))[:n]


@dataclass
class Block:
    """Some whole texts: `lo` is the first row, `offsets` their borders in `data`."""

    lo: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts as byte blocks; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    filled = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(filled)
    if n == 0:
        return
    _, offsets_buffer, data_buffer = filled.buffers()
    offsets = np.frombuffer(offsets_buffer, np.int64)[filled.offset: filled.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        hi = min(hi, n, lo + BLOCK_ROWS)
        yield Block(lo, data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
        lo = hi


def spans(block: Block, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word: a run of word bytes inside one text."""
    inside = is_word[block.data]
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[block.offsets] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    rows = np.searchsorted(block.offsets, starts, "right") - 1
    return starts, ends, rows


def prefix_sums(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hash of the bytes of each span; the length is mixed in."""
    raw = (sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hash(word: bytes, values: np.ndarray = LOWER_VALUES) -> int:
    data = np.frombuffer(word, np.uint8)
    return int(span_hashes(prefix_sums(data, values), np.array([0]), np.array([len(data)]))[0])


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Where each row's items begin in an array sorted by row; n + 1 borders."""
    return np.searchsorted(rows, np.arange(n + 1), "left")
