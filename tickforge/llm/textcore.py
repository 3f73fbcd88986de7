"""Vectorised text kernels shared by the training-data operators.

Everything works on an Arrow string column seen as one UTF-8 byte buffer plus
row offsets, so words, shingles and windows of thousands of documents are
hashed by a few numpy passes instead of per-row Python.

Hashes are 64-bit polynomials over random symbol values (mod 2**64, odd base),
finished by an avalanche mix.  Equal sequences always have equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
#: A second base, for hashes that check the first ones.
CHECK_BASE = 0xD1342543DE82EF95
#: Bytes of text handled by one numpy pass; bounds the memory of a Python worker.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.default_rng(20240229)
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
#: As BYTE_VALUES, with A-Z taken for a-z.
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[ord("A") : ord("Z") + 1] = BYTE_VALUES[ord("a") : ord("z") + 1]

_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, kept and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n).bit_length())
        step = np.full(size, base, dtype=U64)
        step[0] = 1
        have = _powers[base] = np.multiply.accumulate(step, dtype=U64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (the public splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Rolling:
    """Hashes of any slice of a sequence of 64-bit symbols; another base gives independent ones."""

    def __init__(self, symbols: np.ndarray, base: int = _BASE):
        n = len(symbols)
        self.inverse = pow(base, -1, 1 << 64)
        self.prefix = np.zeros(n + 1, dtype=U64)
        np.cumsum(symbols * powers(n, base), dtype=U64, out=self.prefix[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of symbols[start:end] for each pair."""
        inverse = powers(len(self.prefix), self.inverse)
        raw = (self.prefix[ends] - self.prefix[starts]) * inverse[starts]
        return mix(raw + (ends - starts).astype(U64) * U64(0x632BE59BD9B4E019))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and len+1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def row_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows of about max_bytes."""
    data, off = string_buffers(column)
    n, at = len(off) - 1, 0
    while at < n:
        end = int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1
        end = min(n, max(at + 1, end))
        yield at, end, data[off[at] : off[end]], off[at : end + 1] - off[at]
        at = end


class Words:
    """Words of a run of documents: maximal runs of bytes that are no separator."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE, values: np.ndarray = BYTE_VALUES):
        n = len(data)
        inside = ~separator[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(n, dtype=bool)
        before[:1] = True
        before[1:] = ~inside[:-1]
        after = np.empty(n, dtype=bool)
        after[-1:] = True
        after[:-1] = ~inside[1:]
        #: First byte and end byte of each word.
        self.starts = np.flatnonzero(inside & (before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (after | edge[1:])) + 1
        #: Words of document d are first[d]:first[d + 1].
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self._bytes, self._values = data, values

    @cached_property
    def hashes(self) -> np.ndarray:
        """The hash of each word."""
        return Rolling(self._values[self._bytes])(self.starts, self.ends) if len(self._bytes) else np.zeros(0, U64)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)
